"""Files in and out: CSV catalogs, folders of texts, JSON documents and logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns a catalog must have and may have; bytes above which a fetched file counts as there.
REQUIRED, OPTIONAL = ("pope", "title", "link"), ("subtitle", "published_date", "doc_type", "format", "source")
FETCHED_BYTES = 200


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage in the folder of ``spark.checkpoint.dir``."""
    spark = df.sparkSession
    if spark.conf.get("spark.checkpoint.dir", None) is None and spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(scratch(spark))
    return df.checkpoint()


def scratch(spark: SparkSession) -> str:
    """A folder that the driver and all executors share: ``spark.checkpoint.dir``, or in local mode one of this machine."""
    import os
    import re
    import tempfile

    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return shared or os.path.join(tempfile.gettempdir(), "corpusloom-checkpoints")


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, missing ones empty; ``row_pos`` keeps the order within and across files."""
    raw = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, quote='"', escape='"', encoding="utf-8")
    pos = F.monotonically_increasing_id()
    return raw.select(pos.alias("row_pos"), *[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in raw.columns])


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The columns of a catalog: required ones must be there, optional ones are empty if not, the format is html."""
    raw = read_csv(spark, path)
    if missing := [c for c in REQUIRED if c not in raw.columns]:
        raise KeyError(", ".join(missing))
    default = lambda c: F.lit("html" if c == "format" else "")
    return raw.select("row_pos", *REQUIRED, *[F.col(c) if c in raw.columns else default(c).alias(c) for c in OPTIONAL])


def list_files(spark: SparkSession, path: str, pattern: str = "*.md") -> DataFrame:
    """``name, size`` of each file; the contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", F.col("length").alias("size"))
    return found.select(base_name(F.col("path")).alias("name"), "size")


def base_name(path: Column) -> Column:
    """The last part of a path, percent signs decoded."""
    return F.url_decode(F.replace(F.regexp_extract(path, r"([^/]*)$", 1), F.lit("+"), F.lit("%2B")))


def read_texts(spark: SparkSession, path: str, pattern: str = "*.md") -> DataFrame:
    """``name, text`` of each file, whole, line ends as ``\\n``."""
    raw = spark.read.option("pathGlobFilter", pattern).text(path, wholetext=True)
    return raw.select(base_name(F.col("_metadata.file_path")).alias("name"), F.regexp_replace("value", r"\r\n?", "\n").alias("text"))


def read_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def fetched() -> Column:
    """Whether a fetched file counts as there."""
    return F.coalesce(F.col("size") > FETCHED_BYTES, F.lit(False))


def write_csv(df: DataFrame, path: str, columns: list[str], dry_run: bool = False) -> None:
    """To a folder of its own, never onto what is being read; other columns are left out."""
    if not dry_run:
        df.select(*columns).write.mode("overwrite").csv(path, header=True, quote='"', escape='"')


def publish_csv(df: DataFrame, path: str, columns: list[str], keep: int = 2) -> tuple[int, DataFrame]:
    """A catalog as the next version of a folder: written apart, then made the current one at once.  Returns its number and the catalog as it was written.

    Who reads (:func:`read_published`) sees the old catalog or the new one, whole; a writer that is killed leaves the old
    one.  So a catalog can be published onto the folder it is read from.  The ``keep`` versions before stay readable.
    """
    from corpusloom.sources.commits import Commits

    commits = Commits(df.sparkSession, path)
    place = commits.new_place("data")
    write_csv(df, f"{commits.path}/{place}", columns)
    number, _ = commits.change(lambda version, content: {"place": place, "columns": columns})
    for old in [v for v in commits.versions() if v < number - keep][-keep:]:
        commits.delete(commits.read(old)["place"])
    return number, read_csv(df.sparkSession, f"{commits.path}/{place}")


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a published catalog, as :func:`read_csv` reads it."""
    from corpusloom.sources.commits import Commits

    commits = Commits(spark, path)
    version, content = commits.latest()
    if not version:
        raise FileNotFoundError(f"nothing was published in {path}")
    return read_csv(spark, f"{commits.path}/{content['place']}")


def write_json(df: DataFrame, path: str, dry_run: bool = False) -> None:
    if not dry_run:
        df.write.mode("overwrite").json(path)


def append_events(df: DataFrame, path: str) -> None:
    """Lines of a run log; each has its time and kind first, unless the event has a time of its own."""
    df.write.mode("append").json(path)


def pretty(df: DataFrame) -> Column:
    """Each row as JSON, indented."""
    return F.to_json(F.struct(*df.columns), {"pretty": "true"})


def export_markdown(df: DataFrame, path: str, most: int = 100_000, name: str = "filename", text: str = "text") -> int:
    """One file for each row, for people and small corpora: more than ``most`` rows are refused, not cut.  Returns the number of files.

    A file is written under a name of its task's own and then renamed, so a task that runs twice leaves one whole file.
    """
    n = df.count()
    if n > most:
        raise ValueError(f"{n} documents are more than the {most} an export of single files takes")
    if "://" in path and not path.startswith("file:"):
        raise ValueError("single files are exported to a folder that every machine mounts")
    folder = path.removeprefix("file://")

    def write(batches):
        import os
        import uuid

        os.makedirs(folder, exist_ok=True)
        for b in batches:
            for file, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                part = os.path.join(folder, f".{uuid.uuid4().hex}")
                with open(part, "w", encoding="utf-8", newline="") as f:
                    f.write(body or "")
                os.replace(part, os.path.join(folder, os.path.basename(file)))
            yield b.slice(0, 0)

    df.select(name, text).mapInArrow(write, df.select(name, text).schema).count()
    return n


def write_documents(df: DataFrame, path: str, name: str = "filename", text: str = "text") -> None:
    """A row for each document, in Parquet: small files by the million are no way to keep a corpus."""
    df.select(name, text).write.mode("overwrite").parquet(path)
