"""Personal data and the terms that give it away, in DataFrame functions only.

Entities (email, ip, card, phone) are found by pattern and checked. Then the
corpus tells which words disclose an entity: for a term t and an entity e, the
disclosure is PMI(t; e) / IC(e), with

    PMI(t; e) = log(N * n(t, e) / (n(t) * n(e))),    IC(e) = log(N / n(e)),

where n counts documents of N. It is 1 where t is never seen without e: reading t
then tells as much as reading e. A pair at or above ``DISCLOSURE`` must also be no
chance: of c differing documents with e, s have t, and (exp(1) c n(t) / (s N)) ** s,
a bound on the chance of that, times the number of pairs tested must not exceed
``CHANCE``. ``APART`` documents, at least, are enough for a rare term and a rare
entity; two may be a text and its copy.
Documents differ if the text before e and that after it do (``AROUND`` code points):
they are as many as there are different ones on the side that has fewer. So copies
count once, and where most of the documents with both have an equal side, nothing
is said, for they are near copies.
A disclosing term is removed wherever it stands, in every document; entities are
generalised to their kind.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genespark.llm.common import parted, row_key, whole_text
from genespark.session import materialize

DISCLOSURE = 0.8
APART = 3  # differing documents with both a term and an entity, at least
AROUND = 64  # code points before and after an entity that tell copies from other documents
CHANCE = 0.05  # that any of the pairs tested is flagged by chance, at most
KINDS = ("email", "ip", "card", "phone", "term")
TERM = "[\\p{L}\\p{N}]{3,}"

# The patterns of the four kinds, so written that no start is tried twice and no
# group recurses: a start inside a run that has failed is skipped, and repeats do
# not give back. A card is a whole run of 14 to 19 digits with single separators.
PATTERNS = {
    "email": "(?:\\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
    "card": "(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])",
    "phone": "\\+[0-9][ ().0-9-]+[0-9]",
}


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substring(F.reverse(digits), i, 1).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


VALID = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: v.rlike("^(0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(\\.|$)){4}$"),
    "card": lambda v: _luhn(_digits(v)),
    "phone": lambda v: F.length(_digits(v)).between(10, 15),
}
MAY = {"email": lambda t: F.instr(t, "@") > 0, "ip": lambda t: t.rlike("[0-9]\\.[0-9]"), "card": lambda t: t.rlike("[0-9]{2}|[0-9][ -][0-9]"),
       "phone": lambda t: F.instr(t, "+") > 0}
SPAN = "array<struct<start:int,end:int,value:string>>"


def _placed(found: str, between: str, at: Column | None = None) -> Column:
    """(start, end, value) of matches, from the matches and the texts between them; ``at`` is where the text begins."""
    first = F.lit(0) if at is None else at
    steps = F.zip_with(found, F.slice(between, 1, F.size(found)), lambda v, g: F.struct(v.alias("v"), F.length(g).alias("g"), F.length(v).alias("n")))
    return F.aggregate(
        steps, F.struct(first.cast("int").alias("at"), F.array().cast(SPAN).alias("out")),
        lambda a, x: F.struct(
            (a["at"] + x["g"] + x["n"]).alias("at"),
            F.concat(a["out"], F.array(F.struct((a["at"] + x["g"]).alias("start"), (a["at"] + x["g"] + x["n"]).alias("end"), x["v"].alias("value")))).alias("out")),
        lambda a: a["out"])


def _checked(number: int, kind: str) -> Column:
    good = F.filter(_placed(f"_m_{kind}", f"_g_{kind}"), lambda s: VALID[kind](s["value"]))
    return F.transform(good, lambda s: F.struct(
        s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end"), s["value"].alias("value")))


def entities(docs: DataFrame, out: str = "_entities") -> DataFrame:
    """Add an array of (start, kind, end, value) of the entities of ``text``, sorted; ``kind`` numbers ``KINDS``.

    Matches are leftmost and do not overlap within a kind; those that fail the
    kind's check are dropped. Positions are code points, end exclusive. Null
    texts have none.
    """
    text = whole_text()
    for kind in PATTERNS:
        docs = docs.withColumn(f"_m_{kind}", F.when(MAY[kind](text), F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))).otherwise(
            F.array().cast("array<string>")))
    for kind in PATTERNS:
        docs = docs.withColumn(f"_g_{kind}", F.when(F.size(f"_m_{kind}") > 0, F.split(text, PATTERNS[kind], -1)).otherwise(
            F.array().cast("array<string>")))
    every = [_checked(n, kind) for n, kind in enumerate(PATTERNS)]
    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    some = sum((F.size(f"_m_{k}") for k in PATTERNS), F.lit(0)) > 0
    return docs.withColumn(out, F.when(some, F.array_sort(F.concat(*every))).otherwise(none)).drop(
        *[f"_{c}_{k}" for c in "mg" for k in PATTERNS])


def _masked() -> Column:
    """The text with its entities as white space of the same length, so that their parts are no terms and places stay."""
    done = F.aggregate(
        "_entities", F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda a, s: F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.concat(a["out"], F.array(F.substring(F.col("text"), a["at"] + 1, F.greatest(s["start"] - a["at"], F.lit(0))),
                                       F.repeat(F.lit(" "), F.greatest(s["end"] - F.greatest(a["at"], s["start"]), F.lit(0))))).alias("out")),
        lambda a: F.concat(F.array_join(a["out"], ""), F.substring(F.col("text"), a["at"] + 1, F.length("text"))))
    return F.when(F.size("_entities") > 0, done).otherwise(whole_text())


def _terms() -> Column:
    """Hashes of the distinct terms of a text, entities left out."""
    return F.array_distinct(F.transform(F.regexp_extract_all(F.lower(_masked()), F.lit(TERM), F.lit(0)), lambda w: F.xxhash64(w)))


def _mentions(rows: DataFrame) -> DataFrame:
    """(_doc, entity, before, after), one row per document and entity, with hashes of what stands around its first mention."""
    e = F.col("_e")
    name = F.when(e["kind"] == 0, F.lower(e["value"])).when(e["kind"] == 1, e["value"]).otherwise(_digits(e["value"]))
    left = F.greatest(e["start"] - AROUND, F.lit(0))
    around = F.struct(e["start"].alias("at"), F.xxhash64(F.substring("text", left + 1, e["start"] - left)).alias("before"),
                      F.xxhash64(F.substring("text", e["end"] + 1, F.lit(AROUND))).alias("after"))
    return rows.where(F.size("_entities") > 0).select("_doc", "text", F.explode("_entities").alias("_e")).select(
        "_doc", F.xxhash64(e["kind"], name).alias("entity"), around.alias("_a")).groupBy("_doc", "entity").agg(F.min("_a").alias("_a")).select(
        "_doc", "entity", "_a.before", "_a.after")


def disclosing_terms(rows: DataFrame, mentions: DataFrame, disclosure: float = DISCLOSURE, chance: float = CHANCE) -> DataFrame:
    """(entity, term) hashes whose disclosure and evidence reach the thresholds.

    All documents are counted; a document counts once per entity, term and pair. A
    term can reach ``disclosure`` only if n(t) <= n(e) ** disclosure * N ** (1 - disclosure),
    so a document's frequent terms are never paired with its entities.
    """
    total = rows.count()
    apart = F.least(F.countDistinct("before"), F.countDistinct("after"))
    known = mentions.groupBy("entity").agg(apart.alias("n_contexts"), F.count(F.lit(1)).alias("n_entity")).where(
        (F.col("n_contexts") >= APART) & (F.col("n_entity") < total))
    asked = materialize(mentions.join(known, "entity"))
    words = rows.select("_doc", F.explode(_terms()).alias("term"))
    near, _ = parted(rows, "_doc", asked)
    mine = materialize(near.join(asked.select("_doc").distinct(), "_doc", "left_semi").select("_doc", F.explode(_terms()).alias("term")).distinct())
    # Counted before the join, so a frequent term is a few partial sums and not a row per document.
    n_term = words.groupBy("term").agg(F.count(F.lit(1)).alias("n_term")).join(mine.select("term").distinct(), "term")
    n_term = materialize(n_term)
    rare = F.col("n_term") <= F.pow(F.col("n_entity"), F.lit(disclosure)) * float(total) ** (1 - disclosure) * (1 + 1e-9)
    # A document has one row per entity, and per term.
    pairs = materialize(mine.join(n_term, "term").join(asked, "_doc").where(rare).groupBy("entity", "term", "n_term", "n_entity", "n_contexts").agg(
        F.count(F.lit(1)).alias("n_both"), apart.alias("n_apart")))
    tested = pairs.count()
    share = F.log(F.lit(total) * F.col("n_both") / (F.col("n_term") * F.col("n_entity"))) / F.log(F.lit(total) / F.col("n_entity"))
    s = F.col("n_apart")
    by_chance = s * F.log(math.e * F.col("n_contexts") * F.col("n_term") / (s * total)) + math.log(max(tested, 1))
    return pairs.where((share >= disclosure - 1e-12) & (s >= APART) & (2 * s >= F.col("n_both")) & (by_chance <= math.log(chance))).select("entity", "term")


def term_spans(rows: DataFrame, met: DataFrame) -> DataFrame:
    """(_doc, _terms): the sorted spans of the terms that ``met`` (_doc, term) names, by document.

    A text is walked in its own row, so its words are neither rows nor shuffled; the
    list grows only where a named term stands.
    """
    texts = rows.join(met.groupBy("_doc").agg(F.collect_set("term").alias("_met")), "_doc").select("_doc", "_met", _masked().alias("_mask"))
    texts = texts.select("_doc", "_met", F.regexp_extract_all("_mask", F.lit(TERM), F.lit(0)).alias("_w"), F.split("_mask", TERM, -1).alias("_gap"))
    steps = F.zip_with("_w", F.slice("_gap", 1, F.size("_w")), lambda w, g: F.struct(
        F.length(g).alias("g"), F.length(w).alias("n"), F.array_contains("_met", F.xxhash64(F.lower(w))).alias("hit")))
    span = lambda a, x: F.struct((a["at"] + x["g"]).alias("start"), F.lit(KINDS.index("term")).alias("kind"), (a["at"] + x["g"] + x["n"]).alias("end"))
    found = F.aggregate(
        steps, F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,kind:int,end:int>>").alias("out")),
        lambda a, x: F.struct((a["at"] + x["g"] + x["n"]).alias("at"),
                              F.when(x["hit"], F.concat(a["out"], F.array(span(a, x)))).otherwise(a["out"]).alias("out")),
        lambda a: a["out"])
    # Repeated rows have one text.
    return texts.select("_doc", found.alias("_terms")).distinct()


def private_spans(docs: DataFrame, disclosure: float = DISCLOSURE, chance: float = CHANCE) -> DataFrame:
    """Rows of ``docs`` with ``_entities`` and ``_terms`` (start, kind, end), both sorted.

    Repeated rows keep a row each and have equal spans. Columns whose names
    start with an underscore are the operator's own.
    """
    columns = docs.columns
    rows = materialize(entities(docs.withColumn("_doc", row_key())))
    mentions = materialize(_mentions(rows))
    flagged = materialize(disclosing_terms(rows, mentions, disclosure, chance).select("term").distinct())
    met = materialize(rows.select("_doc", F.explode(_terms()).alias("term")).join(flagged, "term").distinct())
    # Texts without a flagged term stay where they are.
    near, rest = parted(rows, "_doc", met)
    spans = materialize(term_spans(near, met))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    named = near.join(spans, "_doc", "left").withColumn("_terms", F.coalesce("_terms", none))
    return named.unionByName(rest.withColumn("_terms", none)).select(*columns, "_entities", "_terms")


def _plain(spans: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))


def _listed(spans: Column) -> Column:
    name = lambda k: F.element_at(F.array(*[F.lit(x) for x in KINDS]), k + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s["kind"]), s["start"], s["end"])), ",")


def pii_documents(docs: DataFrame) -> DataFrame:
    """doc_id, number of entities by kind, base_sha256 of their spans, and all spans as text, of every document.

    A span is kind:start:end in code points, ordered by start, then kind. A null
    text is empty: no spans.
    """
    rows = private_spans(docs.select("doc_id", "text"))
    count = lambda n: F.size(F.filter("_entities", lambda s: s["kind"] == n)).cast("bigint")
    return rows.select(
        "doc_id", *[count(n).alias(f"n_{k}") for n, k in enumerate(PATTERNS)], F.sha2(_listed(_plain("_entities")), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat(_plain("_entities"), F.col("_terms")))).alias("spans"))


def sanitised(docs: DataFrame) -> DataFrame:
    """Documents with entities generalised to their kind and disclosing terms removed; rows and columns stay.

    Spans that overlap are replaced by one mark, that of the first. Texts without
    spans and null texts are unchanged.
    """
    rows = private_spans(docs).withColumn("_all", F.array_sort(F.concat(_plain("_entities"), F.col("_terms"))))
    marks = F.array(*[F.lit("" if k == "term" else f"[{k.upper()}]") for k in KINDS])
    done = F.aggregate(
        "_all", F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda a, s: F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(s["start"] < a["at"], a["out"]).otherwise(F.concat(a["out"], F.array(
                F.substring(F.col("text"), a["at"] + 1, s["start"] - a["at"]), F.element_at(marks, s["kind"] + 1)))).alias("out")),
        lambda a: F.concat(F.array_join(a["out"], ""), F.substring(F.col("text"), a["at"] + 1, F.length("text"))))
    return rows.withColumn("text", F.when(F.size("_all") > 0, done).otherwise(F.col("text"))).select(*docs.columns)
