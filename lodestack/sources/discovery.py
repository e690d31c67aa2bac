"""Cases in a folder tree: files are listed by Spark, and a case's folder is found by a marker file or by its name.

Nothing is walked on the driver: the binary-file source lists the tree, in parallel from many folders on, and reads no content unless a query asks for it. A
glob on names prunes the listing before rows are made. Owners are found for folders, of which there are fewer than files, by an equi-join
of their ancestors with the roots.

Cases: a tree without cases gives no rows; a file outside all cases has no owner and is left out; a root inside another root owns its own files, or is
part of the outer one (``nested``). Names that begin with _ or . are working files to Spark and never listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Ends of a case's main files, folders that are no cases, names of cases, parts of paths that are left out.
SUFFIXES = {"analysis": "-analysis.json", "benchmark": "-benchmark-input.json", "claims": "-claims-verified.json", "html": "-analysis.html"}
INNER = ("assets", "docs", "original-application", "prior-art", "register")
CASE_NAME = "(?i)^EP[0-9]{8,}$"
SKIPPED, SKIPPED_INSIDE = ("_state", "_logs", ".git", "__pycache__"), ("assets",)
UNSORTED = "未分类"


def listing(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """path (relative to root), length, modified of all files below root whose names match."""
    where = spark._jvm.org.apache.hadoop.fs.Path(root)
    base = where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString().rstrip("/") + "/"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    return files.select(F.substring("path", len(base) + 1, 1 << 20).alias("path"), "length", F.col("modificationTime").alias("modified"), F.col("content"))


def folder(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def roots(files: DataFrame, nested: bool = True) -> DataFrame:
    """root, marker: folders that hold an analysis, with its name (the first by name). files: path.

    Folders inside a case's usual ones are no roots; unless nested, nor is a folder below another root."""
    found = files.filter(F.col("path").endswith(SUFFIXES["analysis"])).groupBy(folder(F.col("path")).alias("root")).agg(F.min(name(F.col("path"))).alias("marker"))
    if nested:
        return found.filter(F.col("root") != "")
    found = found.filter(~F.arrays_overlap(F.split("root", "/"), F.array(*map(F.lit, INNER))))
    above = found.select(F.col("root").alias("inner"), F.explode(_ancestors(F.col("root"), itself=False)).alias("root"))
    inner = above.join(found.select("root"), "root").select(F.col("inner").alias("root")).distinct()
    return found.join(inner, "root", "left_anti")


def _ancestors(path: Column, itself: bool = True) -> Column:
    """All folders from the top down to path."""
    parts = F.split(path, "/")
    depth = F.size(parts) if itself else F.size(parts) - 1
    return F.concat(F.array(F.lit("")), F.when(depth > 0, F.transform(F.sequence(F.lit(1), F.greatest(depth, F.lit(1))), lambda n: F.array_join(F.slice(parts, 1, n), "/"))).otherwise(F.array().cast("array<string>")))


def owned(files: DataFrame, cases: DataFrame) -> DataFrame:
    """root, inside (path below the root) and the other columns of files that lie in a case: the deepest root above each."""
    f = files.withColumn("folder", folder(F.col("path")))
    above = f.select("folder").distinct().select("folder", F.explode(F.array_distinct(_ancestors(F.col("folder")))).alias("root"))
    owner = above.join(cases.select("root"), "root").groupBy("folder").agg(F.max_by("root", F.length("root")).alias("root"))
    inside = F.when(F.col("root") == "", F.col("path")).otherwise(F.expr("substring(path, length(root) + 2)"))
    return f.join(owner, "folder").withColumn("inside", inside).drop("folder", "path")


def case_files(files: DataFrame) -> DataFrame:
    """case_dir, case_id, inside and the other columns of files below a folder named like a case, without working files. No shuffle."""
    parts = F.split("path", "/")
    at = F.array_position(F.transform(parts, lambda p: p.rlike(CASE_NAME)), True)
    f = files.withColumns({"parts": parts, "at": at.cast("int")}).filter((F.col("at") > 0) & ~F.arrays_overlap("parts", F.array(*map(F.lit, SKIPPED))))
    inner = F.slice("parts", F.col("at") + 1, F.size("parts"))
    f = f.filter(~F.arrays_overlap(F.transform(inner, F.lower), F.array(*map(F.lit, SKIPPED_INSIDE))))
    return f.select(F.array_join(F.slice("parts", 1, F.col("at")), "/").alias("case_dir"), F.upper(F.get("parts", F.col("at") - 1)).alias("case_id"), F.array_join(inner, "/").alias("inside"), *[c for c in files.columns if c != "path"])


def category(root: Column) -> Column:
    """The folder that a case's folder lies in."""
    parts = F.split(root, "/")
    return F.when(F.size(parts) > 1, F.element_at(parts, -2)).otherwise(UNSORTED)


def main_file(inside: Column, application: Column, end: str) -> Column:
    """Place (from 0) of a path among the candidates for a case's main page or index: by the application's number, with and without dots, in the
    case's folder, then in register, then any name with that end; null for other paths."""
    bare, plain = F.concat(application, F.lit(end)), F.concat(F.replace(application, F.lit("."), F.lit("")), F.lit(end))
    at = lambda prefix, x: inside == F.concat(F.lit(prefix), x)
    any_name = inside.endswith(end)
    return (
        F.when(at("", bare), 0).when(at("", plain), 1).when(at("register/", bare), 2).when(at("register/", plain), 3)
        .when(any_name & ~inside.contains("/"), 4).when(any_name & inside.startswith("register/") & ~F.substring(inside, 10, 1 << 20).contains("/"), 5)
    )


def main_files(files: DataFrame, end: str, case_col: str = "case_dir", application_col: str = "case_id") -> DataFrame:
    """case_col, file: the first candidate of each case."""
    f = files.withColumn("place", main_file(F.col("inside"), F.col(application_col), end)).filter("place IS NOT NULL")
    return f.groupBy(case_col).agg(F.min_by("inside", F.struct("place", "inside")).alias("file"))


def read_cases(spark: SparkSession, root: str) -> DataFrame:
    """Row per case below root: root, category, application, analysis, benchmark, claims (texts), html (name), and the digests of the first two.

    Only the four kinds of main files are listed, and only the JSON ones are read."""
    json = listing(spark, root, "*.json").select("path", "content")
    pages = listing(spark, root, "*" + SUFFIXES["html"]).select("path", F.lit(None).cast("binary").alias("content"))
    found = roots(json.select("path"))
    own = json.unionByName(pages).withColumns({"root": folder(F.col("path")), "name": name(F.col("path"))}).join(found, "root")
    kind = F.lit(None).cast("string")
    for k, end in SUFFIXES.items():
        kind = F.when(F.col("name").endswith(end), k).otherwise(kind)
    own = own.withColumn("kind", kind).filter("kind IS NOT NULL AND (kind <> 'analysis' OR name = marker)")
    first = lambda k, column: F.min_by(F.when(F.col("kind") == k, column), F.when(F.col("kind") == k, F.col("name")))
    c = own.groupBy("root", "marker").agg(*[first(k, F.col("content")).alias(k) for k in ("analysis", "benchmark", "claims")], first("html", F.col("name")).alias("html"))
    text = lambda k: F.col(k).cast("string").alias(k)
    number = F.split_part(F.coalesce(F.get_json_object(F.col("analysis").cast("string"), "$.meta.application_number"), F.lit("")), F.lit("."), F.lit(1))
    return c.select(
        "root",
        category(F.col("root")).alias("category"),
        F.coalesce(F.nullif(number, F.lit("")), F.replace("marker", F.lit(SUFFIXES["analysis"]), F.lit(""))).alias("application"),
        *[text(k) for k in ("analysis", "benchmark", "claims")],
        "html",
        *[F.coalesce(F.sha2(k, 256), F.lit("")).alias(f"{k}_sha256") for k in ("analysis", "benchmark")],
    )
