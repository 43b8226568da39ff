import re

import pyarrow as pa

from tablework.llm.common import giving_back, map_batches


def resident() -> int:
    with open("/proc/self/status") as f:
        return int(re.search(r"VmRSS:\s+(\d+)", f.read()).group(1)) // 1024


def test_a_task_leaves_no_freed_memory_in_its_worker():
    def run(batches):
        for batch in batches:
            kept = [bytes(5000) for _ in range(40_000)]
            last = bytes(5000)  # stands behind the others on the heap
            yield batch
            del kept
            held.append(last)

    held, before = [], resident()
    batch = pa.RecordBatch.from_pydict({"a": [1]})
    assert list(giving_back(run)(iter([batch]))) == [batch]
    assert resident() - before < 120  # without giving back about 200


def test_batches_pass_unchanged(spark):
    def run(batches):
        yield from batches

    df = spark.range(1000).repartition(3)
    assert sorted(r.id for r in map_batches(df, run, "id long").collect()) == list(range(1000))
    assert map_batches(df.limit(0), run, "id long").count() == 0
