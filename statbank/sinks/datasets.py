"""CSV datasets for users: one dataset or one per level, with documentation beside it."""

from pyspark.sql import DataFrame

from statbank import schema as S
from statbank.operators.dataset import export_order


def write_csv(df: DataFrame, path: str) -> None:
    df.write.options(**S.CSV).csv(path)


#: Rows of one file of a dataset. The files are compressed, which a reader cannot split.
ROWS_PER_FILE = 2_000_000


def write_dataset(df: DataFrame, path: str, per_level: bool = False) -> None:
    """Sorted CSV; the sort is a range exchange, so files follow each other in order.

    Labels are repeated in every row, so the files are gzipped, and none grows beyond ROWS_PER_FILE rows.

    Per-level output is a folder per level that has rows. The long layout sorts by variable
    first, the wide one has no variable.
    """
    first = ["variable_id"] if "variable_id" in df.columns else []
    ordered = df.orderBy(*export_order(*first))
    writer = ordered.write.options(**S.CSV, compression="gzip", maxRecordsPerFile=ROWS_PER_FILE)
    if per_level:
        writer = writer.partitionBy("level")
    writer.csv(path)
