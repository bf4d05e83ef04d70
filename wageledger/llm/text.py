"""Helpers of the operators that read whole texts in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# ASCII white space: the separators of words in every contract.
BLANKS = " \t\n\x0b\x0c\r"


def words(text: str) -> list[bytes]:
    """Runs of anything but ASCII white space, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").split()


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_text(
    df: DataFrame, text_column: str, measure: Callable[[str | None], Iterable[tuple]], fields: str, keep: list[str]
) -> DataFrame:
    """Rows that ``measure`` makes of each text, after the ``keep`` columns of its row.

    Only the kept columns and the text go to Python, in Arrow batches; one batch
    is held at a time.
    """
    added = T._parse_datatype_string(fields)
    schema = T.StructType([df.schema[c] for c in keep] + added.fields)
    arrow = to_arrow_schema(schema)
    source = free_name(df, "text_")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in added.fields]
            taken: list[int] = []
            for i, value in enumerate(batch.column(source)):
                for row in measure(value.as_py()):
                    taken.append(i)
                    for column, item in zip(columns, row, strict=True):
                        column.append(item)
            rows = pa.array(taken, pa.int64())
            kept = [batch.column(c).take(rows).cast(arrow.field(c).type) for c in keep]
            made = [pa.array(v, arrow.field(len(keep) + k).type) for k, v in enumerate(columns)]
            yield pa.RecordBatch.from_arrays([*kept, *made], schema=arrow)

    return df.select(*(df[c] for c in keep), df[text_column].alias(source)).mapInArrow(run, schema)
