"""What to ask catalogs for: ranges, windows, pages. Pure planning, done before tasks start."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import date, datetime, timedelta, timezone
from urllib.parse import parse_qs, urlparse

#: Fixed sizes of the catalogs' interfaces.
ID_BATCH, BATCHES_A_SCAN, BATCHES_A_FETCH = 50, 160, 11
AIRING_PAGES, PAGES_A_REQUEST, AIRING_OVERLAP_DAYS = 100, 83, 14
CHANGE_DAYS, CHANGE_OVERLAP_DAYS, CHANGE_PAGES = 12, 1, 500
EXPORT_KINDS = ("movie", "tv_series", "adult_movie", "adult_tv_series")
LISTED_DOMAINS = ("movie", "series", "season", "episode")


def checked_domains(asked: tuple[str, ...], offered: tuple[str, ...]) -> tuple[str, ...]:
    """The asked domains in the order offered; an unknown or repeated one, or none, is an error."""
    if not asked or len(set(asked)) < len(asked) or set(asked) - set(offered):
        raise ValueError(f"domains must be some of {', '.join(offered)}")
    return tuple(d for d in offered if d in asked)


def id_ranges(after: int, latest: int, size: int = ID_BATCH, batches: int = BATCHES_A_SCAN) -> Iterator[list[tuple[int, int]]]:
    """Requests of up to ``batches`` ranges of ids (first, last) that cover after+1 .. latest."""
    request = []
    for first in range(after + 1, latest + 1, size):
        request.append((first, min(first + size - 1, latest)))
        if len(request) == batches:
            yield request
            request = []
    if request:
        yield request


def airing_windows(start: int, until: int, pages: Callable[[int, int], int], most: int = AIRING_PAGES) -> Iterator[tuple[int, int]]:
    """Windows of seconds whose schedules fit in ``most`` pages, halved until they do; one second that doesn't is an error."""
    if start >= until:
        return
    if pages(start, until) <= most:
        yield start, until
    elif until - start <= 1:
        raise ValueError(f"too many schedules at second {start}")
    else:
        middle = (start + until) // 2
        yield from airing_windows(start, middle, pages, most)
        yield from airing_windows(middle, until, pages, most)


def airing_start(watermark: int) -> int:
    return watermark - AIRING_OVERLAP_DAYS * 86400


def change_windows(watermark: int, until: int, days: int = CHANGE_DAYS, overlap: int = CHANGE_OVERLAP_DAYS) -> list[tuple[date, date]]:
    """Windows of days (first, last) from a day before the watermark to the run's day."""
    day = lambda s: datetime.fromtimestamp(s, timezone.utc).date()
    first, last = day(watermark) - timedelta(days=overlap), day(until)
    out = []
    while first <= last:
        end = min(first + timedelta(days=days - 1), last)
        out.append((first, end))
        first = end + timedelta(days=1)
    return out


def export_names(run: date) -> list[str]:
    """The dumps that a run on a day reads: those of the day before."""
    stamp = (run - timedelta(days=1)).strftime("%m_%d_%Y")
    return [f"{kind}_ids_{stamp}.json.gz" for kind in EXPORT_KINDS]


def next_page(link: str | None, page: int) -> int | None:
    """The page that a list's next link names; it must go forward."""
    if not link:
        return None
    found = parse_qs(urlparse(link).query).get("page", [""])[0]
    if not found.isdigit() or int(found) <= page:
        raise ValueError("the next page does not go forward")
    return int(found)


def retained_overlap(watermark: int | None, days: int) -> int | None:
    """Where an incremental run begins: some days before the start of the last good run."""
    return None if watermark is None else watermark - days * 86400
