"""Shard discovery, categorisation, temporal order, manifest.

The file listing is a DataFrame (``binaryFile`` with the content column
pruned, so no file bytes are read); categorisation and week order are column
expressions on the path relative to the root.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..config import Sources

NO_WEEK = 10 ** 9
CATEGORIES = ("embeddings", "interactions", "users", "items")


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def list_files(spark: SparkSession, root: str, src: Sources = Sources()) -> DataFrame:
    """(path, rel, length) of every data file under ``root``, recursively.

    Keeps the configured suffixes and skips any path with a ``.cache``
    component. Raises ``FileNotFoundError`` when ``root`` does not exist.
    """
    root = root.rstrip("/")
    try:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .load(root).select("path", "length"))
        files.schema  # noqa: B018 - resolve now so a missing root fails here
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            raise FileNotFoundError(f"data folder not found: {root}") from e
        raise
    bare = root.split(":", 1)[1] if root.startswith("file:") else root
    rel = F.expr(f"substring(path, locate({_sql_str(bare)}, path) + {len(bare) + 1})")
    files = files.withColumn("rel", rel)
    suffix = None
    for ext in src.extensions:
        cond = F.col("rel").endswith(ext)
        suffix = cond if suffix is None else suffix | cond
    return files.where(suffix & ~F.col("rel").rlike(r"(^|/)\.cache(/|$)"))


def categorize(files: DataFrame, src: Sources = Sources()) -> DataFrame:
    """First matching category in the fixed order (case-insensitive regex)."""
    expr = None
    for cat, pat in src.patterns:
        cond = F.col("rel").rlike("(?i)" + pat)
        expr = F.when(cond, F.lit(cat)) if expr is None else expr.when(cond, F.lit(cat))
    return files.withColumn("category", expr).where(F.col("category").isNotNull())


def week_col(path_col: str = "rel"):
    """S3 key: first ``week_N`` in the relative path, else 10**9."""
    return F.expr(
        rf"coalesce(try_cast(nullif(regexp_extract({path_col}, 'week_(\\d+)', 1), '') AS int), {NO_WEEK})"
    ).alias("week")


def manifest(files: DataFrame, src: Sources = Sources()) -> DataFrame:
    """(category, week, path, rel, shard, ord) in temporal order.

    ``ord`` is the 0-based position of the file inside the category by (week,
    path). ``shard`` is the relative path up to and including its ``week_N``
    component, a file or a folder of part files; without one, the file's folder.
    ``max_shards`` keeps all files of the first N interaction shards by (week,
    shard); embeddings are dropped when ``use_embeddings`` is off. The listing
    has one row per file, so the per-category windows are bounded by the file
    count.
    """
    df = categorize(files, src).withColumn("week", week_col())
    of_week = F.regexp_extract("rel", r"^((?:[^/]*/)*?[^/]*week_\d+[^/]*)", 1)
    df = df.withColumn("shard", F.when(of_week != "", of_week).otherwise(
        F.regexp_replace("rel", r"/[^/]*$", "")))
    w = Window.partitionBy("category").orderBy("week", "path")
    df = df.withColumn("ord", F.row_number().over(w) - 1)
    if src.max_shards:
        by_shard = Window.partitionBy("category").orderBy("week", "shard")
        df = (df.withColumn("_nth", F.dense_rank().over(by_shard))
              .where((F.col("category") != "interactions") | (F.col("_nth") <= int(src.max_shards)))
              .drop("_nth"))
    if not src.use_embeddings:
        df = df.where(F.col("category") != "embeddings")
    return df.select("category", "week", "path", "rel", "shard", "ord", "length")


def validate(man, required=("interactions", "users", "items")) -> None:
    """Every required category has at least one file."""
    present = (man.categories() if isinstance(man, Listing)
               else {r["category"] for r in man.select("category").distinct().collect()})
    missing = [c for c in required if c not in present]
    if missing:
        raise ValueError(f"no files for categories {missing}")


def total_bytes(man, category: str) -> int:
    """Bytes of one category's files (sizes the stage partitions)."""
    if isinstance(man, Listing):
        return man.total_bytes(category)
    row = man.where(F.col("category") == category).agg(F.sum("length").alias("b")).first()
    return int(row["b"] or 0)


def paths(man, category: str) -> list[str]:
    """Ordered file paths of one category.

    ``man`` is the manifest DataFrame or a ``Listing`` already collected
    (one row per file, the same list Spark's own file index keeps on the
    driver).
    """
    if isinstance(man, Listing):
        return man.paths(category)
    rows = man.where(F.col("category") == category).orderBy("week", "path").select("path").collect()
    return [r["path"] for r in rows]


class Listing:
    """The manifest collected once: ordered paths and bytes per category."""

    def __init__(self, man: DataFrame):
        rows = man.select("category", "week", "path", "shard", "length").collect()
        self._rows = sorted(rows, key=lambda r: (r["category"], r["week"], r["path"]))

    def paths(self, category: str) -> list[str]:
        return [r["path"] for r in self._rows if r["category"] == category]

    def total_bytes(self, category: str) -> int:
        return sum(int(r["length"] or 0) for r in self._rows if r["category"] == category)

    def shards(self, category: str) -> list[str]:
        return list(dict.fromkeys(r["shard"] for r in self._rows if r["category"] == category))

    def categories(self) -> set[str]:
        return {r["category"] for r in self._rows}
