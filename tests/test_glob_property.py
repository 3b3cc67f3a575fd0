"""Property: the hour-range glob selects exactly the inclusive hour range, each hour once."""

import datetime as dt
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from clickweave.sources.raw_log import hour_range_glob


def expand(pattern: str) -> list[str]:
    """Expand one level of ``{a,b,...}`` alternation (what the builder emits)."""
    m = re.search(r"\{([^{}]*)\}", pattern)
    if not m:
        return [pattern]
    out = []
    for alt in m.group(1).split(","):
        out += expand(pattern[: m.start()] + alt + pattern[m.end():])
    return out


def selected_hours(pattern: str, universe: list[dt.datetime]) -> list[str]:
    got = []
    for alt in expand(pattern):
        assert alt.startswith("/b/") and alt.endswith("/*")
        sel = alt[len("/b/"): -len("/*")]
        day, _, hour = sel.partition("/")
        for h in universe:
            if h.strftime("%Y-%m-%d") == day and (hour == "*" or h.strftime("%H") == hour):
                got.append(h.strftime("%Y-%m-%d-%H"))
    return got


@settings(max_examples=150, deadline=None)
@given(
    start=st.datetimes(min_value=dt.datetime(2023, 12, 25), max_value=dt.datetime(2024, 3, 5)),
    span=st.integers(min_value=0, max_value=24 * 9),
)
def test_hour_glob_is_exact(start, span):
    start = start.replace(minute=0, second=0, microsecond=0)
    end = start + dt.timedelta(hours=span)
    fmt = "%Y-%m-%d-%H"
    pattern = hour_range_glob("/b", start.strftime(fmt), end.strftime(fmt))
    lo, hi = start - dt.timedelta(days=2), end + dt.timedelta(days=2)
    universe = [lo + dt.timedelta(hours=i) for i in range(int((hi - lo).total_seconds() // 3600) + 1)]
    got = selected_hours(pattern, universe)
    want = [h.strftime(fmt) for h in universe if start <= h <= end]
    assert sorted(got) == want  # every wanted hour, nothing else, none twice
