"""Mixed timestamp normalisation: stamps in many written forms become UTC microseconds, by offset enumeration.

A wall time without an offset lies in the row's zone. Every distinct offset that the zone ever has is subtracted from it and each
candidate instant is rendered back in the zone: one candidate that gives the wall time again is the answer; two mean that the clock
was set back (the later instant has the offset after the change); none means that the clock skipped it, and then the two offsets
around the change are those that render into each other, of which the larger one holds after the change.

Slashed dates that can be read in one order only vote for it in their source; those that can be read in both take the order with
more than ``MARGIN`` times the other's votes, else the day first.

Scale: forms, votes and candidates are column expressions. Stamps are parsed once and written narrow, as votes must be known before any
undecided row can be read. Votes are summed before they are shuffled. A source that holds more than
one in ``HOT`` of the undecided rows meets its votes by a broadcast of fewer than ``HOT`` rows (a bound by construction); all other
sources meet theirs in a shuffle join, where none holds a large share. The zones that are broadcast are names of the time zone database.

Cases: a null, empty or impossible stamp (24:00, 31 April, offset +15:00), and one in no known form, is bad: utc_us null, ambiguous
false, no vote. So is a wall time whose zone is null or unknown; a stamp with an offset, and an epoch, needs no zone. A null source is a
source of its own. Repeated rows and ids stay and each votes. Texts may have any length; only whole matches count. An
empty table gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import BLANK, table

#: Votes for an order must exceed this many times those for the other.
MARGIN = 1
#: Sources with more than one in HOT of the undecided rows are joined apart.
HOT = 1000
#: Days of which a zone's offsets are taken: years 2000 to 2099 and the days around them (offsets reach to 26 hours).
FIRST_DAY, LAST_DAY = "1999-12-29", "2100-01-04"
DAY_US = 86_400_000_000

# Month names of the written form.
MONTHS = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()

_DATE = f"20[0-9]{{2}}-[0-9]{{2}}-[0-9]{{2}}|20[0-9]{{6}}|[0-9]{{2}}[.][0-9]{{2}}[.]20[0-9]{{2}}|[0-9]{{2}} (?:{'|'.join(MONTHS)}) 20[0-9]{{2}}|[0-9]{{2}}/[0-9]{{2}}/20[0-9]{{2}}"
_TIME = "[T\\x20][0-9]{2}:[0-9]{2}(?::[0-9]{2})?(?:\\x20?[AP]M)?(?:\\x20?(?:Z|[+-][0-9]{2}:?[0-9]{2}))?"
WRITTEN = f"\\A(?:{_DATE})(?:{_TIME})?\\z"


def _number(text: Column, start: int | Column, length: int) -> Column:
    start = F.lit(start) if isinstance(start, int) else start
    return F.substring(text, start, F.lit(length)).try_cast("int")


def _days(year: Column, month: Column, day: Column) -> Column:
    """Days since 1970, null for a date that the calendar doesn't have (years 2000 to 2099: every fourth is a leap year)."""
    length = F.when(month.isin(4, 6, 9, 11), 30).when(month != 2, 31).when(year % 4 == 0, 29).otherwise(28)
    first = F.unix_date(F.make_date(year, F.greatest(F.lit(1), F.least(F.lit(12), month)), F.lit(1)))
    return F.when(month.between(1, 12) & day.between(1, length), (first + day - 1).cast("long"))


def known_zones(spark: SparkSession) -> list[str]:
    """Names of the time zone database that the session's Java runs on."""
    return sorted(spark._jvm.java.time.ZoneId.getAvailableZoneIds().toString()[1:-1].split(", "))


def parse(stamps: DataFrame, id_col: str, source_col: str, zone_col: str, raw_col: str) -> DataFrame:
    """Per stamp: kind (bad, epoch, plain, both), epoch_us, day (the only reading, or day first), other (month first where both
    differ), tod_us, offset_us (null: the zone decides), vote_day and vote_month (0 or 1)."""
    zones = known_zones(stamps.sparkSession)
    rows = stamps.select(
        F.col(id_col).alias("stamp_id"),
        F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("source"),
        F.when(F.col(zone_col).isin(zones), F.col(zone_col)).alias("zone"),
        F.btrim(F.col(raw_col), F.lit(BLANK)).alias("s"),
    )
    s = F.col("s")
    form = F.when(~s.rlike(WRITTEN), None).when(F.substring(s, 5, 1) == "-", "ymd-").when(F.substring(s, 3, 1) == ".", "dmy").when(F.substring(s, 3, 1) == "/", "slash").when(F.substring(s, 3, 1) == " ", "dby").otherwise("ymd")
    rows = rows.withColumn("form", F.when(s.rlike("\\A[0-9]{10}\\z"), "seconds").when(s.rlike("\\A[0-9]{13}\\z"), "millis").otherwise(form))
    f = F.col("form")
    month = F.lit(None).cast("int")
    for k, name in enumerate(MONTHS, 1):
        month = F.when(F.substring(s, 4, 3) == name, k).otherwise(month)
    at = F.when(f.isin("ymd-", "dmy", "slash"), 11).when(f == "dby", 12).when(f == "ymd", 9)
    rows = rows.withColumns(
        {
            "y": F.when(f.isin("ymd-", "ymd"), _number(s, 1, 4)).when(f == "dby", _number(s, 8, 4)).otherwise(_number(s, 7, 4)),
            "m": F.when(f == "ymd-", _number(s, 6, 2)).when(f == "ymd", _number(s, 5, 2)).when(f == "dby", month).otherwise(_number(s, 4, 2)),
            "d": F.when(f == "ymd-", _number(s, 9, 2)).when(f == "ymd", _number(s, 7, 2)).otherwise(_number(s, 1, 2)),
            "time": F.substring(s, at, F.lit(40)),
        }
    )
    time, bare = F.col("time"), F.col("time") == ""
    tail = F.substring(time, F.when(F.substring(time, 7, 1) == ":", 10).otherwise(7), F.lit(40))
    rows = rows.withColumns(
        {
            "hour": F.when(bare, 0).otherwise(_number(time, 2, 2)),
            "minute": F.when(bare, 0).otherwise(_number(time, 5, 2)),
            "second": F.when(F.substring(time, 7, 1) == ":", _number(time, 8, 2)).otherwise(0),
            "half": F.when(tail.contains("AM"), 0).when(tail.contains("PM"), 12),
            "shift": F.when(tail.endswith("Z"), "+0000").when(tail.rlike("[+-]"), F.right(F.replace(tail, F.lit(":"), F.lit("")), F.lit(5))),
        }
    )
    hour = F.when(F.col("half").isNull(), F.when(F.col("hour") < 24, F.col("hour"))).when(F.col("hour").between(1, 12), F.col("hour") % 12 + F.col("half"))
    hours, minutes = _number(F.col("shift"), 2, 2), _number(F.col("shift"), 4, 2)
    sign = F.when(F.substring("shift", 1, 1) == "-", -1).otherwise(1)
    rows = rows.withColumns(
        {
            "tod_us": F.when((F.col("minute") < 60) & (F.col("second") < 60), (hour * 3600 + F.col("minute") * 60 + F.col("second")).cast("long") * 1_000_000),
            "offset_us": F.when((hours <= 14) & (minutes < 60), (sign * (hours * 3600 + minutes * 60)).cast("long") * 1_000_000),
            "first": _days(F.col("y"), F.col("m"), F.col("d")),
            "second_order": F.when(f == "slash", _days(F.col("y"), F.col("d"), F.col("m"))),
        }
    )
    placed = F.col("tod_us").isNotNull() & F.when(F.col("shift").isNull(), F.col("zone").isNotNull()).otherwise(F.col("offset_us").isNotNull())
    day, other = F.col("first"), F.col("second_order")
    kind = (
        F.when(f.isin("seconds", "millis"), "epoch")
        .when(f.isNull() | ~placed | F.coalesce(day, other).isNull(), "bad")
        .when(day.isNotNull() & other.isNotNull() & (day != other), "both")
        .otherwise("plain")
    )
    rows = rows.withColumn("kind", F.coalesce(kind, F.lit("bad")))
    votes = (F.col("kind") == "plain") & (f == "slash")
    return rows.select(
        "stamp_id",
        "source",
        "zone",
        "kind",
        F.when(f == "seconds", s.try_cast("long") * 1_000_000).when(f == "millis", s.try_cast("long") * 1000).alias("epoch_us"),
        F.coalesce(day, other).alias("day"),
        other.alias("other"),
        "tod_us",
        "offset_us",
        (votes & other.isNull()).cast("int").alias("vote_day"),
        (votes & day.isNull()).cast("int").alias("vote_month"),
    )


def _offset_at(instant_us: Column, zone: Column) -> Column:
    """The zone's offset at an instant, by rendering it there."""
    return F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(instant_us), zone)) - instant_us


def zone_offsets(zones: DataFrame) -> DataFrame:
    """zone, offsets: every distinct offset (microseconds) of a zone on the days of 2000 to 2099. One row a zone name."""
    first, last = (F.unix_date(F.lit(x).cast("date")) for x in (FIRST_DAY, LAST_DAY))
    each = F.transform(F.sequence(first, last), lambda d: _offset_at(d.cast("long") * DAY_US, F.col("zone")))
    return zones.select("zone", F.array_sort(F.array_distinct(each)).alias("offsets"))


def placed(rows: DataFrame) -> DataFrame:
    """Adds utc_us and doubtful for wall_us in zone with its offsets, where offset_us doesn't say it all."""
    wall = F.col("wall_us")
    rows = rows.withColumn("seen", F.when(F.col("offset_us").isNull(), F.transform("offsets", lambda o: F.struct(o.alias("tried"), _offset_at(wall - o, F.col("zone")).alias("shown")))))
    rows = rows.withColumn("hits", F.transform(F.filter("seen", lambda p: p["tried"] == p["shown"]), lambda p: p["tried"]))
    # Around a skipped time, the offset before the change is shown by the candidate of the one after it, and the other way round.
    after = F.filter("seen", lambda p: (p["shown"] > p["tried"]) & F.exists("seen", lambda q: (q["tried"] == p["shown"]) & (q["shown"] == p["tried"])))
    offset = F.coalesce(F.col("offset_us"), F.array_min("hits"), F.array_max(F.transform(after, lambda p: p["shown"])))
    return rows.withColumns({"utc_us": wall - offset, "doubtful": F.col("offset_us").isNull() & (F.size("hits") != 1)})


def decided(votes: DataFrame) -> DataFrame:
    """Row per source: the order that its votes chose (day, month, or null: neither)."""
    day, month = F.col("vote_day"), F.col("vote_month")
    return votes.withColumn("chosen", F.when(day > MARGIN * month, "day").when(month > MARGIN * day, "month").otherwise("none"))


def normalise(stamps: DataFrame, id_col: str = "stamp_id", source_col: str = "source", zone_col: str = "zone", raw_col: str = "raw", hot: int = HOT) -> DataFrame:
    """Row per stamp: stamp_id, utc_us, rule (bad, epoch, votes, default, plain), ambiguous."""
    rows = table(parse(stamps, id_col, source_col, zone_col, raw_col), "stamps-parsed")
    undecided = (F.col("kind") == "both").cast("int")
    tally = table(rows.groupBy("source", "zone").agg(F.sum("vote_day").alias("vote_day"), F.sum("vote_month").alias("vote_month"), F.sum(undecided).alias("open")), "stamps-tally")
    votes = tally.groupBy("source").agg(*[F.sum(c).alias(c) for c in ("vote_day", "vote_month", "open")]).filter("open > 0")
    votes = table(decided(votes).select("source", "open", "chosen"), "stamps-votes")
    share = (votes.agg(F.sum("open")).first()[0] or 0) / hot
    large = F.broadcast(votes.filter(F.col("open") > share).select("source", "chosen"))
    others = votes.filter(F.col("open") <= share).select("source", "chosen")
    is_open = F.col("kind") == "both"
    near = rows.join(large, "source", "left").filter(~is_open | F.col("chosen").isNotNull())
    far = rows.filter(is_open).join(large, "source", "left_anti").join(others, "source")
    rows = near.unionByName(far)

    offsets = zone_offsets(tally.filter("zone IS NOT NULL").select("zone").distinct())
    day = F.when(is_open & (F.col("chosen") == "month"), F.col("other")).otherwise(F.col("day"))
    rows = rows.withColumn("wall_us", F.when(F.col("kind").isin("plain", "both"), day * DAY_US + F.col("tod_us")))
    rows = placed(rows.join(F.broadcast(offsets), "zone", "left"))
    rule = F.when(is_open, F.when(F.col("chosen") == "none", "default").otherwise("votes")).otherwise(F.col("kind"))
    return rows.select(
        "stamp_id",
        F.when(F.col("kind") == "epoch", F.col("epoch_us")).when(F.col("kind") != "bad", F.col("utc_us")).alias("utc_us"),
        rule.alias("rule"),
        (is_open | ((F.col("kind") == "plain") & F.coalesce(F.col("doubtful"), F.lit(False)))).alias("ambiguous"),
    )
