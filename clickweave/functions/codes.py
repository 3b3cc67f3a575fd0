"""Fixed values that must equal the reference job's for equal results.

Fixed values (do not edit): platform app ids, browser ids, click event codes,
event weights and the per-user event cap.
"""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------
# appids that become "app_<appid>"
APP_IDS = ("apple", "oppo", "xiaomi")
# appids kept as they are; every other appid becomes "other_<appid>"
BROWSER_IDS = ("oppobrowser", "mibrowser")
# click.event -> short event code; anything else is emitted as "None"
CLICK_EVENT_CODES = {
    "clickDoc": "clk",
    "viewComment": "vc",
    "shareDoc": "shr",
    "like": "lk",
    "dislike": "dlk",
    "addComment": "ac",
}
VIEW_EVENT_CODE = "vw"
UNKNOWN_EVENT_CODE = "None"
# event code -> weight: 0 weak, 1..3 strong (positive), 4 strong negative
EVENT_WEIGHTS = {"vw": 0, "clk": 1, "ac": 2, "shr": 3, "lk": 3, "dlk": 4}
# a user with more events than this is dropped whole from training
MAX_EVENTS_PER_USER = 20000
# at most MAX_EVENTS_PER_USER_ROWS // 4 training rows per user
MAX_ROWS_PER_USER = 1000 // 4
# click-extract job: app kept, events carrying a dwell suffix, view filters
CLICK_EXTRACT_APP = "oppobrowser"
DWELL_SUFFIX_EVENTS = ("clickDoc", "play")
SELECTED_CHANNEL = "selected"
PROFILE_MASHTYPE = "profile"
# log-extract job: app kept
LOG_EXTRACT_APP = "vivobrowser"
# training: earliest event kept, as wall-clock time in the job's zone
EVENT_TIME_FLOOR = "2017-09-29 00:00:00"
DEFAULT_TIME_ZONE = "Asia/Shanghai"
DATE_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# enrichment: default document type and default scorer reply
DEFAULT_CTYPE = "news"
SKIPPED_CTYPE = "video"
# ---------------------------------------------------------------------------
