"""What several operators share."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Fixed value: a word is a run of characters other than these white-space ones.
SPACES = r"\x20\x09-\x0D"
WORD = rf"[^{SPACES}]+"


#: Applications whose executors have the package.
SHIPPED: set[str] = set()
#: Bytes of rows that are sent to a worker at once; texts are long and copied there.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def ship(spark: SparkSession) -> None:
    """Sends this package's modules to the executors, as ``--py-files`` does, once.

    Also lowers the bytes that a Python worker gets at once, unless they are few already.
    """
    context = spark.sparkContext
    given = spark.conf.get(BATCH_SETTING).removesuffix("b")
    if not given.isdigit() or int(given) > BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    if context.applicationId in SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    # Read by the driver alone, which hands it out.
    archive = os.path.join(tempfile.mkdtemp(prefix="reviewlake-"), "reviewlake.zip")
    with zipfile.ZipFile(archive, "w") as file:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    file.write(path, os.path.join("reviewlake", os.path.relpath(path, package)))
    context.addPyFile(archive)
    SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_only(df: DataFrame, **new: Column) -> DataFrame:
    """``df`` with the columns ``new``, which replace those of the same name (in any case)."""
    taken = {name.lower() for name in new}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    return df.select(*kept, *[value.alias(name) for name, value in new.items()])


def n_words(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def in_fold(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether the checksum of the id, as text, leaves ``fold``. A null id is in no fold."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))
