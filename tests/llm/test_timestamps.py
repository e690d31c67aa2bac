"""Mixed stamps against a plain reading of the rule with Python's own time zones, and the cases of the docstring."""

import calendar
import re
from collections import Counter
from datetime import UTC, datetime, timedelta
from itertools import product
from zoneinfo import ZoneInfo

import pytest

from lodestack.llm import timestamps

MONTHS = timestamps.MONTHS
TIME = re.compile(r"(?:[T ](\d\d):(\d\d)(?::(\d\d))?(?: ?([AP]M))?(?: ?(Z|[+-]\d\d:?\d\d))?)?", re.ASCII)
FORMS = [(re.compile(p, re.ASCII), order) for p, order in ((r"(20\d\d)-(\d\d)-(\d\d)", "ymd"), (r"(20\d\d)(\d\d)(\d\d)", "ymd"), (r"(\d\d)\.(\d\d)\.(20\d\d)", "dmy"), (rf"(\d\d) ({'|'.join(MONTHS)}) (20\d\d)", "dmy"), (r"(\d\d)/(\d\d)/(20\d\d)", "both"))]


def _day(y, m, d):
    return datetime(y, m, d) if 1 <= m <= 12 and 1 <= d <= calendar.monthrange(y, m)[1] else None


def read(raw, zone):
    """None (bad), an epoch in microseconds, or (readings, time of day, offset or None)."""
    s = (raw or "").strip(" \t\n\x0b\x0c\r")
    if re.fullmatch("[0-9]{10}|[0-9]{13}", s):
        return int(s) * (1_000_000 if len(s) == 10 else 1000)
    for form, order in FORMS:
        if (m := form.match(s)) and (t := TIME.fullmatch(s, m.end())):
            break
    else:
        return None
    a, b, c = (MONTHS.index(x) + 1 if x in MONTHS else int(x) for x in m.groups())
    found = [_day(a, b, c)] if order == "ymd" else [_day(c, b, a)] if order == "dmy" else [_day(c, b, a), _day(c, a, b)]
    h, mi, sec, half, off = t.groups()
    h, mi, sec, offset = int(h or 0), int(mi or 0), int(sec or 0), None
    if half:
        if not 1 <= h <= 12:
            return None
        h = h % 12 + 12 * (half == "PM")
    if off:
        hh, mm = (0, 0) if off == "Z" else (int(off[1:3]), int(off[-2:]))
        if hh > 14 or mm > 59:
            return None
        offset = timedelta(hours=hh, minutes=mm) * (-1 if off[0] == "-" else 1)
    elif not zone:
        return None
    if h > 23 or mi > 59 or sec > 59 or not any(found):
        return None
    return found, timedelta(hours=h, minutes=mi, seconds=sec), offset


def instant(wall, zone):
    """(UTC microseconds, doubtful) by searching the neighbourhood of a wall time for the change."""
    tz = ZoneInfo(zone)
    us = lambda x: (x.replace(tzinfo=UTC) - datetime(1970, 1, 1, tzinfo=UTC)) // timedelta(microseconds=1)
    before, after = ((wall + timedelta(days=k)).replace(tzinfo=UTC).astimezone(tz).utcoffset() for k in (-2, 2))
    hits = sorted({wall - o for o in {before, after} if (wall - o).replace(tzinfo=UTC).astimezone(tz).replace(tzinfo=None) == wall})
    return (us(hits[-1]), len(hits) > 1) if hits else (us(wall - after), True)


def plain(rows):
    parsed, votes = [(r, read(r[3], r[2])) for r in rows], Counter()
    for (_, source, _, _), p in parsed:
        if isinstance(p, tuple) and len(p[0]) == 2 and None in p[0]:
            votes[source, 0 if p[0][0] else 1] += 1
    out = []
    for (i, source, zone, _), p in parsed:
        if not isinstance(p, tuple):
            out.append((i, p, "bad" if p is None else "epoch", False))
            continue
        days, tod, offset = p
        rule, day = "plain", next(d for d in days if d)
        if len(days) == 2 and None not in days and days[0] != days[1]:
            first, second = votes[source, 0], votes[source, 1]
            rule, day = ("default", days[0]) if first == second else ("votes", days[first < second])
        utc, doubtful = instant(day + tod, zone) if offset is None else ((day + tod - offset - datetime(1970, 1, 1)) // timedelta(microseconds=1), False)
        out.append((i, utc, rule, rule != "plain" or doubtful))
    return sorted(map(str, out))


SCHEMA = "stamp_id long, source string, zone string, raw string"


def _got(df, **options):
    return sorted(str(tuple(r)) for r in timestamps.normalise(df, **options).collect())


@pytest.mark.parametrize("hot", [1, 1000])
def test_whole_table_is_the_plain_rule(spark, hot):
    """hot = 1: all sources meet their votes in the shuffle join; 1000: by the broadcast of large ones."""
    stamps = spark.read.parquet("/root/testdata/sf0.01/stamps.parquet")
    assert _got(stamps, hot=hot) == plain([tuple(r) for r in stamps.select("stamp_id", "source", "zone", "raw").collect()])


def test_changes_of_many_zones(spark):
    """Wall times around changes, skipped and repeated ones, a skipped day, half-hour changes, zones with many offsets."""
    walls = {"America/New_York": ["2024-03-10 02:30", "2024-11-03 01:30", "2007-03-11 02:00"], "Europe/Berlin": ["2024-03-31 02:00", "2024-03-31 03:00", "2024-10-27 02:59", "2099-03-29 02:15"]}
    walls |= {"Pacific/Apia": ["2011-12-30 12:00", "2011-12-31 00:00", "2011-12-29 23:59"], "Australia/Lord_Howe": ["2024-04-07 01:45", "2024-10-06 02:10"], "Europe/Moscow": ["2011-03-27 02:30", "2014-10-26 01:30"]}
    walls |= {"Asia/Pyongyang": ["2015-08-14 23:45", "2018-05-04 23:40"], "America/Caracas": ["2007-12-09 02:45", "2016-05-01 02:45"], "Antarctica/Troll": ["2024-03-31 02:00", "2024-10-27 02:00"], "Asia/Kolkata": ["2024-01-01 00:00"]}
    rows = [(k, "s", zone, w) for k, (zone, w) in enumerate((z, w) for z, ws in walls.items() for w in ws)]
    assert _got(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_forms_and_limits(spark):
    dates = ["2024-02-29", "2023-02-29", "20240430", "20240431", "31.12.2099", "00.01.2024", "29 Feb 2000", "05 nov 2024", "13/01/2024", "01/13/2024", "05/05/2024", "05/06/2024", "31/04/2024", "32/13/2024", "2024-13-01", "1999-12-31", "5.1.2024", "1234567890", "1234567890123", "123456789", "0000000000"]
    times = ["", "T00:00", " 23:59:59", " 24:00", " 12:60", " 11:59:60", " 12:00 AM", " 12:00PM", " 13:00 PM", " 00:30 AM", "T01:02:03Z", "T01:02 Z", "T01:02+0530", "T01:02-14:00", "T01:02+14:59", "T01:02+15:00", "T01:02+01:60", " 1:02", " 01:02 am", " 01:02:03 PM +01:00", "T01:02z", " ", "\n"]
    rows = [(k, f"s{k % 3}", "Europe/Berlin", pad + d + t + pad) for k, (d, t, pad) in enumerate(product(dates, times, ("", "\t \x0b")))]
    rows += [(9000 + k, "s0", "UTC", raw) for k, raw in enumerate(["２０２４-01-01", "2024-01-01 ", " 2024-01-01", "2024-01-01 00:00 " + "x" * 300_000, "9" * 300_000, "T01:02", "2024-01-0１"])]
    assert _got(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_votes_nulls_repeats_and_other_columns(spark):
    both, day, month = "03/04/2024 10:00", "23/04/2024 10:00", "04/23/2024 10:00"
    rows = [(1, "d", "UTC", both), (2, "d", "UTC", day), (3, "m", "UTC", both), (4, "m", "UTC", month), (5, "t", "UTC", both), (6, "t", "UTC", day), (7, "t", "UTC", month), (8, "n", "UTC", both)]
    rows += [(9, None, "UTC", both), (10, None, "UTC", month), (11, "", "UTC", both), (12, "w", "UTC", both), (13, "w", None, month), (14, "w", "UTC", "04/23/2024 24:00"), (15, "o", None, both + " +0100"), (16, "o", None, month + "Z")]
    rows += [(17, "d", None, "2024-01-01"), (18, "d", "Nowhere/Land", both), (None, None, None, None), (1, "d", "UTC", both), (19, "d", None, "1700000000"), (20, "r", "UTC", both), (21, "r", "UTC", month), (21, "r", "UTC", month), (22, "r", "UTC", day)]
    df = spark.createDataFrame([(*r, "x", 5, "y") for r in rows], SCHEMA + ", kind string, day int, chosen string")
    known = [(i, s, z if z != "Nowhere/Land" else None, raw) for i, s, z, raw in rows]
    for hot in (1, 3, 1000):
        assert _got(df, hot=hot) == plain(known)
    assert timestamps.normalise(df.limit(0)).count() == 0
