"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Only expressions and joins of Spark SQL. Texts are never shuffled; fixed-width columns are:

1. one scan makes the length of the normalised text and a hash of its first ``prefix`` characters; a length that
   one row has is settled;
2. of the other lengths, a pair (length, prefix hash) that one row has is settled;
3. a second scan makes SHA-256 of the whole normalised text for the rows that are left. The pairs that are left reach
   it as a bitmap of 2**24 bits, the broadcast of which never exceeds 262,144 words whatever the input's size. Two pairs may
   share a bit: that costs a digest too many and decides nothing, since groups are made by the digest.

Each row of a group that survives step 3 gets the row that stays by a many-to-one join on the digest; settled rows
take no part in it. A group may hold any share of the rows: the group's row is a partial aggregate, and the join is
broadcast or, beyond the bound, a sort-merge join between two exchanges whose skewed partitions AQE splits.

Cases: a null text counts as empty, and all empty texts are one group. Ties on length in code points go to
the smallest id, a null id last; rows repeated with the same id are all members, and all rows that carry the
id that stays and the longest text are kept. Texts of any length are hashed whole. An empty table gives an empty result.
Columns other than the two named are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import small, stripped, table

BITS = 24


def raw_key(text):
    """128 bits of the text as it came, to find a row again by its id."""
    text = F.coalesce(text, F.lit(""))
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(7), text).alias("b"))


def _scan(docs: DataFrame, id_col: str, text_col: str, prefix: int) -> DataFrame:
    """The normalised text is made once a row; what reads it is chosen by the caller."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.length(text).alias("n_chars"), raw_key(F.col(text_col)).alias("raw"), stripped(text).alias("norm"))
    return rows.withColumns({"norm_len": F.length("norm"), "head": F.xxhash64(F.substring("norm", 1, prefix))})


def _bit():
    return F.pmod(F.xxhash64("norm_len", "head"), F.lit(1 << BITS))


def refine(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = 256, digest_all: bool = False) -> DataFrame:
    """Row per document: doc_id, n_chars, raw, norm_len, full_hash (null where settled before), keep_id, keep_chars, group_size.

    digest_all adds the column digest, the SHA-256 also of the texts that were settled before; decisions never use it."""
    rows = _scan(docs, id_col, text_col, prefix)
    digest = F.unhex(F.sha2("norm", 256)).alias("digest")
    keys = table(rows.select("doc_id", "n_chars", "raw", "norm_len", "head", *[digest] * digest_all), "dedup-keys")

    lengths = keys.groupBy("norm_len").count().filter("count > 1").select("norm_len")
    heads = keys.select("norm_len", "head").join(small(table(lengths, "dedup-len")), "norm_len", "left_semi").groupBy("norm_len", "head").count().filter("count > 1")
    bits = heads.select(_bit().alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
    bits = F.broadcast(table(bits, "dedup-bits"))  # at most 2**18 rows

    open_ = F.expr("coalesce(shiftright(bits, cast(bit & 63 as int)) & 1, 0) = 1")
    source = (keys if digest_all else rows).withColumn("bit", _bit()).withColumn("word", F.shiftright("bit", 6)).join(bits, "word", "left")
    full = F.when(open_, F.col("digest") if digest_all else F.unhex(F.sha2("norm", 256))).alias("full_hash")
    hashed = table(source.select("doc_id", "n_chars", "raw", "norm_len", *["digest"] * digest_all, full), "dedup-full")

    best = F.min(F.struct((-F.col("n_chars")).alias("neg"), F.col("doc_id").isNull().alias("no_id"), "doc_id"))
    groups = hashed.filter("full_hash is not null").groupBy("full_hash").agg(best.alias("best"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    groups = table(groups.select("full_hash", F.col("best.doc_id").alias("best_id"), (-F.col("best.neg")).alias("best_chars"), "n"), "dedup-groups")
    settled = hashed.filter("full_hash is null").withColumns({"best_id": F.lit(None).cast(hashed.schema["doc_id"].dataType), "best_chars": F.lit(None).cast("int"), "n": F.lit(None).cast("long")})
    joined = hashed.filter("full_hash is not null").join(small(groups), "full_hash", "left").unionByName(settled)
    alone = F.col("n").isNull()
    return joined.select(
        "doc_id",
        "n_chars",
        "raw",
        "norm_len",
        "full_hash",
        *["digest"] * digest_all,
        F.when(alone, F.col("doc_id")).otherwise(F.col("best_id")).alias("keep_id"),
        F.when(alone, F.col("n_chars")).otherwise(F.col("best_chars")).alias("keep_chars"),
        F.coalesce(F.col("n"), F.lit(1)).alias("group_size"),
    )


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = 256, digest_all: bool = False) -> DataFrame:
    """Row per document, dropped ones too: doc_id, keep_id, group_size, kept and the keys that decided."""
    out = refine(docs, id_col, text_col, prefix, digest_all)
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars"))
    digest = [F.lower(F.hex("digest")).alias("digest")] * digest_all
    return out.select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), kept.alias("kept"), "n_chars", "raw", "norm_len", "full_hash", *digest)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = 256) -> DataFrame:
    """The rows of docs that stay, all columns as they came.

    The rejected rows are narrow, found again by id, length and 128 bits of the raw text, so that an id repeated with another
    text doesn't go with it; the join that removes them is broadcast while they are few and a shuffled anti join otherwise.
    """
    gone = decisions(docs, id_col, text_col, prefix).filter("not kept")
    gone = small(table(gone.select("doc_id", "n_chars", F.col("raw.a").alias("a"), F.col("raw.b").alias("b")).distinct(), "dedup-gone"))
    raw = raw_key(docs[text_col])
    same = docs[id_col].eqNullSafe(gone["doc_id"]) & (F.length(F.coalesce(docs[text_col], F.lit(""))) == gone["n_chars"])
    return docs.join(gone, same & (raw["a"] == gone["a"]) & (raw["b"] == gone["b"]), "left_anti")
