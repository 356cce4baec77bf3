"""The operators on edge cases and on a small table, against plain versions and the tokenizer libraries."""

import random
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import edge
from conftest import SMALL
from genespark.llm import language, packing, pieces, pii, quality, sharding, simhash, substrings, token_counts, topk


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(edge.rows(), edge.SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def some(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], edge.SCHEMA)


def both(docs, some):
    """(DataFrame, [(doc_id, text)]) of the edge cases and of the small table."""
    return [(d, [(r.doc_id, r.text) for r in d.select("doc_id", "text").collect()]) for d in (docs, some)]


def counted(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def test_token_counts_equal_the_library(docs, some, none):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    for df, texts in both(docs, some):
        want = Counter()
        for i, t in texts:
            n = len(library.encode(t or "", add_special_tokens=False).ids)
            want[i, len((t or "").encode()), n, n > 512] += 1
        assert counted(token_counts.count_tokens(df, path), "doc_id", "n_bytes", "n_tokens", "over_limit") == want
    assert token_counts.count_tokens(none, path).count() == 0


def test_fast_splitting_equals_the_library():
    from tokenizers import Tokenizer

    from genespark.llm import pretokens

    r = random.Random(1)
    parts = [" ", "a", "The", "'s", "'S", "é", "É", "İ", "ß", "<|endoftext|>", "\n", "\x1c", "\x85", "\xa0", "12", "½", "…", "😀", "中", "ﬁ", "ǅ", "Ⱥ", "!!", "\x00", "<|"]
    byte, word = (Tokenizer.from_file(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
    ids = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    for _ in range(3000):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 7)))
        assert list(memoryview(ids.of(t)).cast("I")) == word.encode(t, add_special_tokens=False).ids, t
        if "<|" not in t:
            got = pretokens.byte_level_pieces(t, byte)
            assert "".join(got) == t and got == [t[a:b] for _, (a, b) in byte.pre_tokenizer.pre_tokenize_str(t)], t


def test_pieces_equal_the_library_and_decode(docs, some, none):
    from sentencepiece import SentencePieceProcessor

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = SentencePieceProcessor(model_file=path)
    for df, texts in both(docs, some):
        want = Counter()
        for i, t in texts:
            ids = library.encode(t or "", add_eos=True)
            want[i, len(ids), edge.sha(" ".join(map(str, ids))), edge.sha(library.decode(ids))] += 1
        assert counted(pieces.encode_and_decode(df, path), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    assert pieces.encode_and_decode(none, path).count() == 0


def test_packing_keeps_every_piece_and_few_sequences(docs, some, none):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    for df, texts in both(docs, some):
        want, lengths = Counter(), []
        for i, t in texts:
            ids = library.encode(t or "", add_special_tokens=False).ids + [0]
            for k, at in enumerate(range(0, len(ids), 2048)):
                part = ids[at:at + 2048]
                want[i, k, at, len(part), edge.crc(part)] += 1
                lengths.append(len(part))
        got = packing.pack_documents(df, path).collect()
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
        ends = Counter()
        for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
            assert r.offset == ends[r.sequence_id]
            ends[r.sequence_id] += r.length
        assert max(ends.values()) <= 2048 and len(ends) <= edge.least_bins(lengths, 2048) * 1.02 + 1
    assert packing.pack_documents(none, path).count() == 0


def test_packing_of_one_hot_length_and_tiny_pieces(spark):
    for lengths, most in (([700] * 900 + [3] * 50, 451), ([1] * 3000, 3), ([2048, 1024, 1024, 1025, 1023], 3)):
        df = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id bigint, length bigint")
        got = packing.pack_pieces(df).collect()
        assert len(got) == len(lengths) and len({(r.sequence_id, r.offset) for r in got}) == len(lengths)
        used = Counter()
        for r in got:
            used[r.sequence_id] += r.length
        assert max(used.values()) <= 2048 and len(used) <= most


def test_language_of_held_out_texts(some, docs, none):
    got = {r.doc_id: r for r in language.identify(some).collect()}
    lang = {r.doc_id: r.lang for r in some.collect()}
    held = [i for i, r in got.items() if r.held_out]
    assert len(got) == some.count() and held and sum(got[i].lang_pred == lang[i] for i in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())
    edge_rows = language.identify(docs).collect()
    assert len(edge_rows) == docs.count()
    assert {r.lang_pred for r in edge_rows if r.doc_id in (0, 1, 2, 3)} == {"und"}
    assert language.identify(none).count() == 0


def test_language_predictions_do_not_see_the_label(some):
    model = language.fit(some.where(~language.held_out() & F.col("lang").isNotNull()))
    texts = [r.text for r in some.limit(20).collect()]
    direct = language.score_texts(texts, *model)[0]
    blind = some.limit(20).withColumn("lang", F.lit(None).cast("string"))
    assert language.identify(some.unionByName(blind.withColumn("doc_id", F.col("doc_id") + 10_000))).where("doc_id >= 10000").count() == 20
    assert len(set(direct)) > 1


def test_quality_base_counts_and_verdicts(docs, some, none):
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for df, texts in both(docs, some):
        got = quality.quality_documents(df)
        assert counted(got, *columns) == Counter((i, *edge.base_quality(t)) for i, t in texts)
        assert got.where("base_failed and kept").count() == 0
    assert quality.quality_documents(none).count() == 0


def test_weak_supervision_finds_bad_kinds_and_keeps_good():
    good, symbols, caps = (1, 1, 1, 1, 0), (-1, 1, 1, 1, 0), (1, 1, -1, 1, -1)
    p = quality.posteriors({good: 900, symbols: 60, caps: 40, (1, 0, 1, 1, 0): 5})
    assert p[good] > 0.9 and p[1, 0, 1, 1, 0] > 0.9 and p[symbols] < 0.5 and p[caps] < 0.5
    assert quality.posteriors({}) == {}


def test_quality_agrees_with_labels(spark):
    d = "/root/testdata/sf0.01"
    got = quality.quality_documents(spark.read.parquet(f"{d}/documents.parquet"))
    met = got.join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id")
    bad = met.where("quality = 0").agg(F.avg(F.col("kept").cast("double"))).first()[0]
    good = met.where("quality = 1 and not base_failed").agg(F.avg(F.col("kept").cast("double"))).first()[0]
    assert bad < 0.05 and good > 0.99


def test_simhash_and_components(docs, some, none):
    for df, texts in both(docs, some):
        prints = [edge.simhash(t) for _, t in texts]
        want = Counter(zip([i for i, _ in texts], [format(p, "016x") for p in prints], edge.linked(prints, [i for i, _ in texts]), strict=True))
        assert counted(simhash.simhash_documents(df), "doc_id", "fingerprint", "component_id") == want
    assert simhash.simhash_documents(none).count() == 0


def test_probes_find_every_pair_within_two_bits(spark):
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(40)] + [0, 2**64 - 1]
    prints = set(base)
    for b in base:
        for n in (1, 1, 2, 2, 2, 3):
            prints.add(b ^ sum(1 << x for x in r.sample(range(64), n)))
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fingerprint_bits bigint")
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    got = {(min(x.a, x.b), max(x.a, x.b)) for x in simhash.linked(df).collect()}
    assert got == want


def test_chunks_cover_the_text_and_resist_shifts():
    for t in edge.TEXTS:
        spans = substrings.split_text(t or "")
        assert "".join((t or "")[a:b] for a, b, _, _ in spans) == (t or "")
        assert sum(n for _, _, n, _ in spans) == len(edge.words(t)) or len(t or "") > 4000
    plain = {d for *_, d in substrings.split_text(edge.PASSAGE)}
    moved = {d for *_, d in substrings.split_text("something in front of it, " + edge.PASSAGE)}
    assert len(plain & moved) >= len(plain) - 3


def test_repeated_passages_are_found_and_cut(docs, some, none):
    got = substrings.repeated_passages(docs).collect()
    spans = {r.doc_id: r for r in got}
    assert spans[14].first_doc_id == 13 and spans[14].n_words >= 40
    text = edge.TEXTS[14][spans[14].start:spans[14].end]
    assert text.strip() in edge.PASSAGE
    assert 13 not in spans and 5 not in spans and 6 not in spans
    for df in (docs, some):
        out = substrings.without_repeats(df)
        assert out.columns == df.columns and out.count() == df.count()
    left = {r.doc_id: r.text for r in substrings.without_repeats(docs).collect()}
    assert left[13] == edge.TEXTS[13] and len(left[14]) < len(edge.TEXTS[14]) and left[0] is None
    for r in substrings.repeated_passages(some).where("doc_id <> first_doc_id").collect():
        source = {x.doc_id: x.text for x in some.where(F.col("doc_id").isin(r.doc_id, r.first_doc_id)).collect()}
        first = " ".join(source[r.doc_id][r.start:r.end].split()[:6])
        assert first in " ".join(source[r.first_doc_id].split())
    assert substrings.repeated_passages(none).count() == 0 and substrings.without_repeats(none).count() == 0


def test_pii_base_equals_plain_patterns(docs, some, none):
    for df, texts in both(docs, some):
        want = Counter()
        for i, t in texts:
            n, digest = edge.private(t)
            want[i, *n, digest] += 1
        assert counted(pii.pii_documents(df), "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == want
        out = pii.sanitised(df)
        assert out.columns == df.columns and out.count() == df.count()
    assert pii.pii_documents(none).count() == 0


def test_pii_patterns_on_random_strings(spark):
    r = random.Random(7)
    bits = ["a", "@", ".", "b-c", "1", "22", "333", " ", "-", "+", "(", ")", "4111111111111111", "10.0.0.1", "_", "\n", "é", "0"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(1, 25))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {x.doc_id: x for x in pii.pii_documents(df).collect()}
    for i, t in enumerate(texts):
        n, digest = edge.private(t)
        assert ([got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone], got[i].base_sha256) == (n, digest), t


def test_disclosing_terms_are_removed_and_clean_text_stays(spark):
    head = ["on monday", "last spring", "after lunch", "some people", "nobody here", "every tuesday", "our office", "the report"]
    rows = [(i, f"{h} we wrote to Zanzibarov at zed@mail.example.com about {h} again") for i, h in enumerate(head)]
    rows += [(100 + i, f"a clean text number {i} about mail and people, the office and the report") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    left = {r.doc_id: r.text for r in pii.sanitised(df).collect()}
    assert all("Zanzibarov" not in left[i] and "[EMAIL]" in left[i] and "zed@" not in left[i] for i in range(8))
    assert all(left[i] == t for i, t in rows if i >= 100)
    assert pii.pii_documents(df).where("doc_id < 100 and spans like '%term:%'").count() == 8


def test_shards_are_even_and_keep_equal_texts_together(docs, some, none):
    for df, texts in both(docs, some):
        got = sharding.shard_documents(df).collect()
        assert len(got) == len(texts)
        by_shard, by_text = {}, {}
        for r in got:
            by_shard.setdefault(r.shard, []).append(r.slot)
            by_text.setdefault((r.text_crc32, r.size), set()).add(r.shard)
        assert all(sorted(s) == list(range(len(s))) for s in by_shard.values()) and set(by_shard) <= set(range(16))
        assert all(len(s) == 1 for s in by_text.values())
    assert sharding.shard_documents(none).count() == 0
    load = Counter()
    for r in sharding.shard_documents(some).collect():
        load[r.shard] += r["size"]
    assert max(load.values()) <= 1.02 * sum(load.values()) / 16


def test_many_small_groups_give_even_shards(spark):
    rows = spark.range(20_000).select((F.col("id") * 2654435761).alias("grp"), (F.col("id") % 97 + 1).alias("size"))
    got = sharding.shard_groups(rows, 4).groupBy("shard").agg(F.sum("size").alias("s")).collect()
    total = sum(r.s for r in got)
    assert len(got) == 4 and max(r.s for r in got) <= 1.02 * total / 4


def plain_loads(sizes, shards):
    """Loads of groups taken largest first, one by one."""
    loads = [0] * shards
    for size in sorted(sizes, reverse=True):
        loads[loads.index(min(loads))] += size
    return loads


def test_shards_equal_one_by_one_scheduling(spark):
    r = random.Random(9)
    for shards in (1, 3, 16):
        groups = [(g, r.choice([1, 1, 1, 5, 7, 7, 40, r.randint(1, 3000)])) for g in range(400)] + [(1000, 50_000)]
        df = spark.createDataFrame([(g, s) for g, s in groups for _ in range(1 + g % 3)], "grp bigint, size bigint")
        got = sharding.shard_groups(df, shards).groupBy("shard").agg(F.sum("size").alias("s")).collect()
        load = [0] * shards
        for x in got:
            load[x.shard] = x.s
        assert load == plain_loads([s * (1 + g % 3) for g, s in groups], shards)
    for _ in range(300):
        loads = [r.randint(0, 50) for _ in range(r.randint(1, 6))]
        size, count = r.randint(1, 9), r.randint(0, 40)
        want = list(loads)
        for _ in range(count):
            want[want.index(min(want))] += size
        got = sharding.take_turns(loads, size, count)
        assert [x + k * size for x, k in zip(loads, got, strict=True)] == want


def brute_top(vectors, queries, k):
    out = set()
    for q, qv in queries.items():
        best = sorted((-max(min(sum(a * b for a, b in zip(qv, v, strict=True)), 2**63 - 2), 2 - 2**63), i) for i, v in vectors if i != q and len(v) == len(qv))[:k]
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(best)}
    return out


def test_top_k_equals_brute_force(spark):
    r = random.Random(3)
    vec = [(i, [r.gauss(0, 1) for _ in range(6)]) for i in range(400)]
    vec += [(400 + i, vec[7][1]) for i in range(30)]  # ties
    vec += [(500, [1.0] * 3), (520, [2.0, 0.0, -1.0]), (540, [1.0] * 9), (560, None), (580, [float("nan")] * 6), (600, [float("inf")] + [0.0] * 5), (620, [None] * 6), (640, [1e15] * 6), (660, [1e15] * 6), (680, [3e7] * 6), (700, [1e30] + [-1.0] * 5), (701, [7.3e16] * 6), (703, [-1e30, 1e30] + [2.0] * 4)]
    df = spark.createDataFrame(vec, "vec_id bigint, embedding array<double>").repartition(5)
    whole = topk.whole_numbers(df)
    kept = [(x.vec_id, [int(c) for c in x.v]) for x in whole.collect()]
    assert {560, 580, 600, 620}.isdisjoint(i for i, _ in kept) and len(kept) == len(vec) - 4
    got = topk.nearest(whole, whole.where("vec_id % 20 = 0")).collect()
    want = brute_top(kept, {i: v for i, v in kept if i % 20 == 0}, 20)
    assert {tuple(x) for x in got} == want and len(got) == len(want)
    empty = whole.where("vec_id < 0")
    assert topk.nearest(empty, empty).count() == 0 and topk.nearest(whole, empty).count() == 0


def test_pruning_skips_blocks_whose_bound_is_too_low():
    import numpy as np

    blocks = [(np.arange(10) + 10 * b, np.full((10, 4), 100 - 10 * b)) for b in range(8)]
    best, who, scored = topk.search((np.array([999]), np.ones((1, 4), "i8")), blocks, 5)
    assert who.tolist() == [[0, 1, 2, 3, 4]] and best.tolist() == [[400] * 5] and scored == 1


def test_every_shared_passage_of_50_words_has_a_run_of_whole_chunks():
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(1, 9)))
    for k in range(600):
        passage = " ".join(word() for _ in range(50 + k % 3))
        texts = [" ".join(word() for _ in range(r.randint(0, 60))) + " " + passage + " " + " ".join(word() for _ in range(r.randint(0, 60))) for _ in range(2)]
        first = {d for *_, d in substrings.split_text(texts[0])}
        most = run = 0
        for _, _, n, d in substrings.split_text(texts[1]):
            run = run + n if d in first else 0
            most = max(most, run)
        assert most >= substrings.MIN_WORDS, passage


def test_passages_without_white_space_are_found_at_other_places(spark):
    r = random.Random(4)
    han = lambda n: "".join(chr(0x4E00 + r.randrange(3000)) for _ in range(n))
    line = lambda n: "".join(r.choice("abcdefghij0123456789+/") for _ in range(n))
    passage, code = han(400), line(1200)
    rows = [(1, han(700) + passage + han(90)), (2, han(333) + passage + han(50)), (3, line(500) + code), (4, line(77) + code + line(30)), (5, han(900))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    left = {x.doc_id: x.text for x in substrings.without_repeats(df).collect()}
    assert all(left[i] == t for i, t in rows if i in (1, 3, 5))
    assert 383 <= len(left[2]) <= 383 + 120 and 107 <= len(left[4]) <= 107 + 360
    for t in (rows[0][1], rows[3][1], "a" * 9000, "ab " * 3000):
        assert "".join(t[a:b] for a, b, _, _ in substrings.split_text(t)) == t
