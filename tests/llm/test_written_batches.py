"""Arrow batches of what ``cut`` writes."""

import pyarrow as pa
from pyspark.sql import functions as F

from dqloom.llm.common import cut


def test_batches_are_bounded_in_bytes(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "bytes": [batch.nbytes]})

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    texts = spark.range(0, 2000, 1, 1).select(F.repeat(F.lit("x"), 10_000).alias("text"))
    found = cut(texts.mapInArrow(sizes, "rows long, bytes long"), "sizes").agg(F.sum("rows"), F.max("bytes")).first()
    assert found[0] == 2000 and found[1] < 5 * 2**20
    assert spark.conf.get(key) == before
