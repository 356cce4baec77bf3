"""The intake store: folders by digits, compaction, and a paralog that arrives late."""

import random

from genespark.operators.presence import compete, presence_cells
from genespark.streaming import intake

HIT = "query_proteome string, query_id string, target_proteome string, target_id string, evalue double"


def test_folders_cover_every_batch_once():
    for fan in (2, 3, 16):
        for n in range(1, 300):
            held = [b for k, j in intake.folders(n, fan) for b in range(j * fan**k, (j + 1) * fan**k)]
            assert held == list(range(n))
            levels = len({k for k, _ in intake.folders(n, fan)})
            assert len(intake.folders(n, fan)) <= (fan - 1) * levels and fan ** (levels - 1) <= n


def cells(df):
    return sorted(((r.source_proteome, r.protein_id, r.proteome, r.best_evalue) for r in df.collect()), key=str)


def test_batches_equal_one_computation_with_late_paralogs_and_retries(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(intake, "FAN", 2)
    r = random.Random(5)
    hits = [(f"N{r.randrange(3)}", f"P{r.randrange(6)}", f"N{3 + r.randrange(3)}", f"T{r.randrange(8)}", 10.0 ** -r.randrange(6, 40)) for _ in range(220)]
    paralogs = spark.createDataFrame([(f"P{i}", f"P{(i + 1) % 6}") for i in range(6)], "protein_id string, paralog_id string")
    # The hit of a paralog to the same target, much better than the first, comes in the last batch.
    hits = [("N0", "P0", "N4", "Tx", 1e-9)] + hits + [("N0", "P1", "N4", "Tx", 1e-60)]
    store, out = str(tmp_path / "store"), str(tmp_path / "out")
    parts = [hits[i::7] if i < 6 else [] for i in range(6)] + [hits[6::7] + hits[-1:]]
    for i, part in enumerate(parts):
        df = spark.createDataFrame(part, HIT)
        intake.merge_batch(df, i, store, out, paralogs)
        if i in (1, 3):
            intake.merge_batch(df, i, store, out, paralogs)  # retried
    whole = presence_cells(compete(spark.createDataFrame(hits, HIT).groupBy(*intake.KEY).agg({"evalue": "min"}).withColumnRenamed("min(evalue)", "evalue"), paralogs))
    assert cells(intake.read_presence(spark, out)) == cells(whole)
