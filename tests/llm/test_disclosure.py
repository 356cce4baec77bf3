"""Disclosing terms against a plain version, on texts where a name stands far from its address and in other texts."""

import math
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from genespark.llm import pii

MAIL = re.compile(r"[a-z0-9]+@[a-z0-9.]+[a-z]")


def words(text):
    return set(re.findall(r"[^\W_]{3,}", MAIL.sub(lambda m: " " * len(m[0]), text).lower()))


def plain(texts):
    """Terms that disclose an address, by counting over all documents."""
    n = len(texts)
    terms = [words(t) for t in texts]
    count = defaultdict(int)
    for w in terms:
        for t in w:
            count[t] += 1
    places, context = defaultdict(set), {}
    for i, t in enumerate(texts):
        for m in MAIL.finditer(t):  # one per text here
            places[m[0].lower()].add(i)
            context[i] = (t[max(0, m.start() - 64):m.start()], t[m.end():m.end() + 64])
    differ = lambda docs: min(len({context[i][side] for i in docs}) for side in (0, 1))
    tested = []
    for e, docs in places.items():
        apart = differ(docs)
        if apart < 3 or len(docs) == n:
            continue
        for t in {t for i in docs for t in terms[i]}:
            if count[t] <= len(docs) ** 0.8 * n**0.2 * (1 + 1e-9):
                met = [i for i in docs if t in terms[i]]
                tested.append((t, len(docs), apart, len(met), differ(met)))
    out = set()
    for t, n_e, c, both, s in tested:
        share = math.log(n * both / (count[t] * n_e)) / math.log(n / n_e)
        if share >= 0.8 - 1e-12 and s >= 3 and 2 * s >= both and s * math.log(math.e * c * count[t] / (s * n)) + math.log(len(tested)) <= math.log(0.05):
            out.add(t)
    return out


def corpus(seed):
    r = random.Random(seed)
    common = [f"word{i}" for i in range(1500)]
    some = lambda k: " ".join(r.choice(common) + ("" if r.random() < 0.9 else str(r.randrange(10**6))) for _ in range(k))
    texts = []
    for p in range(12):  # people with 2 to 6 texts; the name is far from the address
        for _ in range(2 + p % 5):
            texts.append(f"{some(40)} Person{p}name {some(60)} mail{p}@host.example.com {some(10)} p{p}nick {some(3)}")
    texts.append(f"{some(30)} here Person4name is alone {some(30)}")  # without the address
    copy = f"{some(50)} copied@host.example.com {some(50)} uniqueword"
    texts += [copy + f" tail{k}" for k in range(30)]  # near copies prove nothing
    texts += [some(80) for _ in range(900)]
    return texts


def test_disclosing_terms_equal_the_plain_count(spark):
    texts = corpus(1)
    want = plain(texts)
    assert "person4name" in want and "uniqueword" not in want
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(4)
    got = pii.pii_documents(df).collect()
    found = set()
    for x in got:
        for span in filter(None, x.spans.split(",")):
            kind, a, b = span.split(":")
            if kind == "term":
                found.add(texts[x.doc_id][int(a):int(b)].lower())
    assert found == want
    left = {x.doc_id: x.text for x in pii.sanitised(df).collect()}
    for i, t in enumerate(texts):
        assert not words(left[i].replace("[EMAIL]", " ")) & want
        if not words(t) & want and not MAIL.search(t):
            assert left[i] == t
    assert sum(left[i] == t for i, t in enumerate(texts)) >= 900


def test_rare_terms_of_one_text_are_no_evidence(spark):
    rows = [(i, f"text {i} only{i} rare{i} with m{i}@host.example.com and things") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert pii.pii_documents(df).where("spans like '%term%'").count() == 0


def test_term_spans_walk_texts_in_their_rows(spark):
    """Words of a text that has a flagged term are neither rows nor shuffled."""
    texts = {1: "Anna, anna und \U0001F600 ANNA x Bert. " * 40, 2: "bert", 3: "none here", 4: ""}
    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    rows = spark.createDataFrame([(k, v) for k, v in [*texts.items(), (1, texts[1])]], "_doc long, text string").withColumn("_entities", none)
    met = spark.createDataFrame([(1, "anna"), (1, "bert"), (2, "bert")], "_doc long, word string").select("_doc", F.xxhash64("word").alias("term"))
    spans = pii.term_spans(rows, met)
    plan = spans._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Window" not in plan
    want = {d: [(m.start(), 4, m.end()) for m in re.finditer("anna|bert", texts[d].lower())] for d in (1, 2)}
    got = [(r["_doc"], [tuple(x) for x in r["_terms"]]) for r in spans.collect()]
    assert len(got) == 2 and dict(got) == want


def test_texts_without_a_key_are_not_shuffled(spark):
    """A table is parted by the keys it may meet; no key is lost, and the texts pass no exchange."""
    from genespark.llm.common import parted

    rows = spark.range(5000).select(F.when(F.col("id") % 50 > 0, F.xxhash64("id")).alias("k"), F.col("id").cast("string").alias("text"))
    keys = spark.range(0, 9000, 7).select(F.xxhash64("id").alias("k"), "id")
    near, rest = parted(rows, "k", keys)
    assert near.columns == rest.columns == ["k", "text"]
    assert "hashpartitioning" not in near.unionByName(rest)._jdf.queryExecution().executedPlan().toString()
    want = {str(i) for i in range(0, 5000, 7) if i % 50}
    found, left = ({r.text for r in x.collect()} for x in (near, rest))
    assert want <= found and not found & left and len(found) + len(left) == 5000 and len(found) < 2 * len(want)


def test_flagged_terms_leave_other_texts_where_they_are(spark):
    """With joins that are never broadcast, texts reach the result without a shuffle unless they may hold a flagged term."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(corpus(1))], "doc_id bigint, text string").repartition(4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = pii.private_spans(df)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "Union" in plan
        got = {(r.doc_id, r.text, str(r._entities), str(r._terms)) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == {(r.doc_id, r.text, str(r._entities), str(r._terms)) for r in pii.private_spans(df).collect()} and len(got) == df.count()
