import json
import random

from pyspark.sql import functions as F

from siftline.functions import values as V
from siftline.functions.values import MISSING
from siftline.operators import journal
from siftline.streaming import journal_stream


def lines(n, seed):
    rng = random.Random(seed)
    out = []
    for seq in range(1, n + 1):
        result = None if rng.random() < 0.2 else {v: rng.choice([MISSING, f"{v}-{seq}", None]) for v in V.CONTACTS}
        out.append({"seq": seq, "version": 1, "row_index": rng.randrange(2, 9), "siret": "1", "company_name": "a", "result": result, "status": rng.choice(["success", "not_found", "technical_error"]), "overwrite_existing": rng.random() < 0.15})
    rng.shuffle(out)  # files hold records of a row in any order
    return out


def test_the_stream_is_the_replay_at_every_trigger(spark, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        folder, latest = tmp_path / "in", {}
        folder.mkdir()
        records = lines(150, 4)

        def take(batch, number):
            for r in batch.collect():
                latest[r.row_index] = tuple(r)

        for i in range(3):
            (folder / f"{i}.json").write_text("".join(json.dumps(r) + "\n" for r in records[i * 50 : (i + 1) * 50]))
            query = journal_stream.replayed(journal_stream.records(spark, str(folder))).writeStream.foreachBatch(take).outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
            query.awaitTermination(120)
            assert query.exception() is None
            folded = journal.folded(journal.from_records(journal.read(spark, str(folder))))
            columns = [c.split()[0] for c in journal_stream.FOLDED.split(", ")]
            want = {r.row_index: tuple(r) for r in folded.withColumns({"any_result": F.coalesce("any_result", F.lit(False))}).select(*columns).collect()}
            assert latest == want and len(want) == 7
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
