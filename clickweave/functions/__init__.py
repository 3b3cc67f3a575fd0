from clickweave.functions.codes import (  # noqa: F401
    APP_IDS, BROWSER_IDS, CLICK_EVENT_CODES, EVENT_WEIGHTS, MAX_EVENTS_PER_USER,
)
