"""The pipeline's stages on edge cases and on the small table, against plain versions."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import edge
from conftest import SMALL


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(edge.rows(), edge.SCHEMA.replace(", _x int", ", extra int")).repartition(3).cache()


def test_every_stage_takes_edge_cases_and_keeps_columns(spark, docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        assert [t for _, t in out.dtypes] == [t for _, t in docs.dtypes], name
        out.count()
    assert corpus_pipeline.pack(spark, docs, SMALL).count() >= docs.count()


CLASHES = ["_n", "_id", "_key", "_set", "_bands", "_cut", "row", "_row", "_doc", "_entities", "_terms", "node", "component", "kept", "digest"]


def test_stages_keep_columns_whose_names_are_their_own(spark, docs):
    more = docs.select("doc_id", "text", "lang", "source", "n_chars", *[F.concat(F.lit(c), F.coalesce(F.col("doc_id"), F.lit(-1))).alias(c) for c in CLASHES])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, more, SMALL)
        assert out.columns == more.columns, name
        rows = out.collect()  # before the next stage, which deletes what this one wrote
        plain = stage(spark, docs.select("doc_id", "text", "lang", "source", "n_chars"), SMALL)
        assert Counter(tuple(r[c] for c in plain.columns) for r in rows) == Counter(tuple(r) for r in plain.collect()), name
        for r in rows:
            assert all(r[c] == c + str(-1 if r.doc_id is None else r.doc_id) for c in CLASHES), name


def test_every_stage_takes_an_empty_table(spark, docs):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SMALL).count() == 0, name


def test_near_duplicates_keep_one_of_each_group(spark, docs):
    rows = docs.select("doc_id", "text").collect()
    ids = edge.linked([edge.simhash(r.text) for r in rows], [r.doc_id for r in rows])
    groups = {i for i in ids if i is not None}
    kept = [r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SMALL).collect()]
    assert groups <= set(kept) and len([k for k in kept if k is not None]) == len(groups)


def test_run_packs_what_the_stages_leave(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = corpus_pipeline.near_duplicates(spark, corpus_pipeline.quality_rules(spark, docs, SMALL), SMALL)
    kept = {r.doc_id for r in kept.select("doc_id").collect()}
    out = corpus_pipeline.run(spark, SMALL)
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == kept
    used = Counter()
    for r in out.collect():
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 2048


def test_clean_documents_pass_unchanged(spark):
    good = [(i, " ".join(f"term{(i * 131 + k * 17) % 9973}x{k % 7}" for k in range(80)).capitalize() + ".") for i in range(30)]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in good], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        assert {tuple(r) for r in stage(spark, df, SMALL).select("doc_id", "text").collect()} == set(good), name


def test_near_duplicates_find_edited_copies_by_shingle_similarity(spark):
    """Planted copies with 5-word similarity of about 0.8 to 0.95, and copies below 0.8 that stay."""
    import random

    r = random.Random(11)
    word = lambda: f"w{r.randrange(10**6)}"
    rows, gone = [], set()
    for g in range(60):
        base = [word() for _ in range(200)]
        rows.append((1000 * g, " ".join(base)))
        for k, edits in enumerate((1, 2, 3, 4, 9)):
            copy = list(base)
            for at in range(edits):
                copy[10 + 20 * at] = word()
            rows.append((1000 * g + k + 1, " ".join(copy)))
            if edits < 5:
                gone.add(1000 * g + k + 1)
    hot = [word() for _ in range(120)]
    for k in range(400):  # one group of near copies, each edited once elsewhere
        copy = list(hot)
        copy[r.randrange(120)] = word()
        rows.append((10**6 + k, " ".join(copy)))
        gone |= {10**6 + k} if k else set()
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = {x.doc_id for x in corpus_pipeline.near_duplicates(spark, df, SMALL).collect()}
    assert kept == {i for i, _ in rows} - gone


def test_checked_pairs_grow_with_a_group_and_not_with_its_square(spark):
    """Texts that share a third to a half of their words with all others of a group, and near copies: pairs checked a text."""
    import random

    from genespark.llm import similar

    r = random.Random(12)
    word = lambda: f"w{r.randrange(10**6)}"
    passage, hot = [word() for _ in range(100)], [word() for _ in range(150)]
    rate = {}
    for n in (150, 600):
        rows = [(i, " ".join(passage + [word() for _ in range(60)])) for i in range(n)]  # 0.45 alike
        for i in range(n):
            copy = list(hot)
            copy[r.randrange(150)] = word()
            rows.append((n + i, " ".join(copy)))
        df = similar.with_keys(spark.createDataFrame(rows, "doc_id bigint, text string")).withColumn("_n", F.monotonically_increasing_id()).cache()
        groups, checked = similar.linked_groups(df)
        names = Counter(x.component for x in groups.collect())
        assert sorted(names.values())[-1] == n and len(names) == n + 1
        rate[n] = checked / n
    assert rate[600] <= 1.5 * rate[150] + 10, rate


def test_texts_that_share_no_key_are_not_moved(spark, monkeypatch):
    """Of 300 texts 40 have a near copy: only those and their copies are written for the checks, and no other passes a shuffle."""
    import random

    from genespark.llm import similar

    r = random.Random(13)
    text = lambda: [f"w{r.randrange(10**6)}" for _ in range(60)]
    rows = [(i, text()) for i in range(300)]
    rows += [(300 + i, rows[i][1][:59] + ["end"]) for i in range(40)]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id bigint, text string")
    moved, keep = [], similar.materialize
    monkeypatch.setattr(similar, "materialize", lambda t: moved.append(t.count() if "text" in t.columns else 0) or keep(t))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = corpus_pipeline.near_duplicates(spark, df, SMALL)
        assert {x.doc_id for x in out.collect()} == set(range(300))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert sum(moved) == 80 and "Union" in out._jdf.queryExecution().optimizedPlan().toString()


def test_fingerprints_alone_link_the_closest_copies(spark):
    """Copies within two bits of their 5-word SimHash are candidates even without a key of minima; the exact check still decides."""
    import random

    from genespark.llm import similar, simhash

    r = random.Random(14)
    word = lambda: f"w{r.randrange(10**6)}"
    texts = []
    for _ in range(30):
        base = [word() for _ in range(400)]
        texts += [base, [*base, word()], [word(), *base]]
    texts = [" ".join(t) for t in texts]
    texts += ["aa " * 600 + " ".join(word() for _ in range(9)) for _ in range(3)]  # one fingerprint or nearly, not alike
    bits = [simhash.fingerprint(t, similar.WIDTH) for t in texts]
    sets = [set(similar.shingles(t).tolist()) for t in texts]
    linked = {(i, j) for i in range(len(texts)) for j in range(i) if ((bits[i] ^ bits[j]) & (1 << 64) - 1).bit_count() <= 2}
    alike = {(i, j) for i, j in linked if len(sets[i] & sets[j]) >= similar.SIMILAR * len(sets[i] | sets[j])}
    assert len(alike) >= 20 and len(linked) > len(alike)
    df = similar.with_keys(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    df = df.withColumn("_bands", F.array().cast("array<bigint>")).withColumn("_n", F.monotonically_increasing_id()).cache()
    found = {x._set: x.component for x in similar.groups(df).collect()}
    group = {x.doc_id: found[x._set] for x in df.select("doc_id", "_set").collect()}
    assert all(group[i] == group[j] for i, j in alike)
    assert all(group[i] != group[j] for i in range(90, 93) for j in range(93) if i != j)


def test_marks_lose_no_similar_pair():
    """Parities bound the shingles in which two sets differ, so a pair at 0.8 or more always passes."""
    import random

    import numpy as np

    from genespark.llm import similar

    r = random.Random(15)
    for _ in range(400):
        n = r.choice([1, 4, 9, 50, 300, 3000])
        x = np.unique(np.array([r.getrandbits(64) for _ in range(n)], "u8"))
        part = x[: r.randrange(n + 1)]
        y = np.unique(np.concatenate([part, np.array([r.getrandbits(64) for _ in range(r.randrange(n // 3 + 1))], "u8")]))
        px, py = (similar.parities(v).view("u8") for v in (x, y))
        differ = sum(int(v).bit_count() for v in px ^ py)
        both = len(np.intersect1d(x, y))
        assert differ <= len(x) + len(y) - 2 * both
        if both >= similar.SIMILAR * (len(x) + len(y) - both):
            assert (1 + similar.SIMILAR) * differ <= (1 - similar.SIMILAR) * (len(x) + len(y)) + 1e-6


def test_texts_just_below_the_limit_are_not_listed_pair_by_pair(spark):
    """Copies of one text with edits that leave every pair at about 0.7, as many texts as share its rarest shingles."""
    import random

    from genespark.llm import similar

    r = random.Random(16)
    word = lambda: f"w{r.randrange(10**6)}"
    hot, rows = [word() for _ in range(200)], []
    for i in range(300):
        copy = list(hot)
        for at in r.sample(range(5, 195, 10), 4):
            copy[at] = word()
        rows.append((i, " ".join(copy)))
    df = similar.with_keys(spark.createDataFrame(rows, "doc_id bigint, text string")).withColumn("_n", F.monotonically_increasing_id()).cache()
    found, checked = similar.linked_groups(df)
    sets = [set(similar.shingles(t).tolist()) for _, t in rows]
    group = list(range(300))
    for i in range(300):
        for j in range(i):
            if len(sets[i] & sets[j]) >= similar.SIMILAR * len(sets[i] | sets[j]) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    assert Counter(Counter(x.component for x in found.collect()).values()) == Counter(Counter(group).values())
    assert checked <= 3000, checked
