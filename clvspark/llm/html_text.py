"""Main text of web pages: leaf blocks labelled by a conditional random field.

Pages are parsed to leaf blocks inside the tasks, one page at a time; the
trained model (some hundred weights) is trained on the driver from the
bounded set of labelled pages and travels with the tasks.

Defined results: a null or empty page, and one without main text, gives an
empty text; repeated rows give equal results. Other columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from clvspark.llm.block_crf import BlockCRF
from clvspark.llm.dom_blocks import Block, blocks
from clvspark.llm.labelled_pages import labelled_pages


def fit(pages: list[tuple[list[Block], list[int]]] | None = None) -> BlockCRF:
    """A model from labelled pages (blocks and 0/1 labels); by default from the layouts of this package."""
    return BlockCRF().fit(pages or labelled_pages())


def extract_page(page: str | None, model: BlockCRF) -> str:
    found = blocks(page)
    return "\n".join(b.text for b, label in zip(found, model.decode(found), strict=True) if label)


def extract(pages: DataFrame, model: BlockCRF, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep`` and the main text (column ``text``) of every row; blocks are joined by line breaks."""
    source = pages.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)], F.col(html).cast("string").alias("html"))
    schema = StructType([*source.schema.fields[:-1], StructField("text", StringType())])

    def run(batches):
        for batch in batches:
            texts = [extract_page(p, model) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=schema.names)

    return source.mapInArrow(run, schema).toDF(*keep, "text")
