"""Personal data and the terms that give it away.

Base spans (e-mail, IP, card, phone) come from patterns. The method then protects every
value that a document states: an entity e. Over whole documents it counts in how many e
occurs, in how many a term t occurs with e, and in how many t occurs at all;
``disclosure = PMI(t, e) / IC(e)`` is the part of e's information that t gives away
(1: t occurs only with e). Terms whose disclosure reaches a threshold become spans of kind
``term``, wherever they stand: removed above one threshold, generalised above the other.
Counts alone tell that a term goes with a value if enough documents hold both. A value
stated once or twice is given away by the terms that are a part of it (the name in an
address, the last digits of a number): these need no such number, only the disclosure.

Counting is pre-aggregated in the tasks and shuffled by (entity, term) or by term hash, so
an entity or a term that a third of all documents hold is a few rows per task.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from persona_engine.llm import textbytes as tb
from persona_engine.session import materialize

KINDS = ("email", "ip", "card", "phone", "term")
#: Terms are runs of ASCII letters and digits and of non-ASCII characters.
TERM_SEPARATOR = np.ones(256, bool)
TERM_SEPARATOR[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
#: Entities or terms up to this many travel to the tasks to thin what they hand over; beyond, all is shuffled.
BROADCAST_TERMS = 500_000
#: A task hands its term counts over when it holds this many.
TASK_TERMS = 1_000_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_DIGITS = re.compile("[0-9]+")
_WORDS = re.compile("[A-Za-z0-9]+")


@dataclass(frozen=True)
class DisclosurePlan:
    min_docs: int = 3          # documents that hold both a term and the entity, for terms that are no part of it
    generalise: float = 0.8    # disclosure from which a term is generalised
    remove: float = 0.95       # and removed
    everywhere: bool = False   # also in documents that don't state the value


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # the leftmost match before an @ starts where the run of local characters starts, or where the last match ended
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            last = m.end()
        at = text.find("@", max(at + 1, last))


def _luhn(digits: str) -> bool:
    double = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (double + sum(map(int, digits[-1::-2]))) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) in code points, by start, then kind."""
    found = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(ch.isdigit() for ch in m.group()) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def _entity(kind: int, text: str) -> str:
    """An entity's key: its kind and value without case, spaces and punctuation that vary."""
    value = text.lower() if kind == 0 else text if kind == 1 else "".join(ch for ch in text if ch.isdigit())
    return f"{KINDS[kind]}:{value}"


def _entity_hash(kind: int, text: str) -> int:
    return int.from_bytes(hashlib.blake2b(_entity(kind, text).encode(), digest_size=8).digest(), "little", signed=True)


def value_parts(kind: int, text: str) -> list[str]:
    """The terms of a value that say much of it: words of an e-mail address of 3 characters or more (but the last
    label), and numbers of 4 digits or more of a card or phone; lower-cased."""
    if kind == 0:
        return sorted({p.lower() for p in _WORDS.findall(text.rpartition(".")[0]) if len(p) >= 3})
    return sorted({p for p in _DIGITS.findall(text) if len(p) >= 4}) if kind in (2, 3) else []


def _term_hashes(terms: list[str]) -> list[int]:
    """The hashes that ``_terms`` gives these terms (not empty)."""
    data = [t.encode() for t in terms]
    ends = np.cumsum([0, *map(len, data)])
    prefix = tb.prefix_hash(tb.LOWER[np.frombuffer(b"".join(data), np.uint8)])
    return tb.span_hash(prefix, ends[:-1], ends[1:]).view(np.int64).tolist()


def _entities(text: str | None) -> list[int]:
    """Hashes of the values a text states."""
    return sorted({_entity_hash(kind, text[a:b]) for a, kind, b in base_spans(text)}) if text else []


def _among(h: np.ndarray, wanted: np.ndarray | None) -> np.ndarray:
    """Which of the hashes are in a sorted array; None: all."""
    if wanted is None or not len(wanted):
        return np.full(len(h), wanted is None)
    return wanted[np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)] == h


def _thin(hashes: DataFrame) -> np.ndarray | None:
    """The one column's values, sorted, if there are few enough to travel to the tasks."""
    if hashes.count() > BROADCAST_TERMS:
        return None
    return np.sort(np.asarray(hashes.toArrow().column(0).combine_chunks()).astype(np.int64))


def _terms(c: tb.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, text index and hash of every term of a chunk."""
    a, b, text = tb.word_spans(c, TERM_SEPARATOR)
    return a, b, text, tb.span_hash(tb.prefix_hash(tb.LOWER[c.buf]), a, b).view(np.int64)


def entity_terms(docs: DataFrame, wanted: np.ndarray | None) -> DataFrame:
    """entity, term, n: partial counts of the documents that hold both, for the wanted entities (None: all)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0)
            stated = [[e for e in _entities(t) if _among(np.array([e]), wanted)[0]] for t in texts.to_pylist()]
            at = [i for i, e in enumerate(stated) if e]
            for c in tb.chunks(texts.take(pa.array(at, pa.int64()))):
                _, _, text, h = _terms(c)
                holders: dict[int, list[np.ndarray]] = {}
                for i in range(c.n):
                    lo, hi = np.searchsorted(text, [i, i + 1])
                    mine = np.unique(h[lo:hi])
                    for e in stated[at[c.first + i]]:
                        holders.setdefault(e, []).append(mine)
                for e, parts in holders.items():
                    term, n = np.unique(np.concatenate(parts), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(term), e)), pa.array(term), pa.array(n.astype(np.int64))], names=["entity", "term", "n"])

    return docs.selectExpr("cast(text as string) text").mapInArrow(run, "entity bigint, term bigint, n bigint")


_BASE = "rid bigint, doc_id bigint, text_key bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string"
_SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"
_PLACES = "array<struct<term:bigint,start:bigint,end:bigint>>"


def entity_documents(docs: DataFrame) -> DataFrame:
    """entity, term, n: partial counts of the documents that state each value, by each term that is a part of it and
    (a null term) by itself; a row of a null entity counts the task's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for text in batch.column(0).to_pylist():
                mine = set()
                for a, kind, b in base_spans(text) if text else []:
                    entity, parts = _entity_hash(kind, text[a:b]), value_parts(kind, text[a:b])
                    mine.add((entity, None))
                    mine.update((entity, t) for t in (_term_hashes(parts) if parts else []))
                found.update(mine)
            entity, term = ([k[i] for k in found] for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array([None, *entity], pa.int64()), pa.array([None, *term], pa.int64()),
                                              pa.array([batch.num_rows, *found.values()], pa.int64())], names=["entity", "term", "n"])

    return docs.selectExpr("cast(text as string) text").mapInArrow(run, "entity bigint, term bigint, n bigint")


def find_base(docs: DataFrame, wanted: np.ndarray | None) -> DataFrame:
    """Base counts and spans, hashes of the values stated, and places of the wanted terms (None: all) outside base spans, for each row; rid numbers the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = batch.column(2).to_pylist()
            places: dict[int, list[tuple[int, int, int]]] = {}
            for c in tb.chunks(batch.column(2)):
                a, b, text, h = _terms(c)
                hit = np.flatnonzero(_among(h, wanted))
                if not len(hit):
                    continue
                point = np.zeros(len(c.buf) + 1, np.int64)
                np.cumsum((c.buf & 0xC0) != 0x80, out=point[1:])
                first = point[c.offsets[text[hit]]]
                for i, *place in zip(text[hit].tolist(), h[hit].tolist(), (point[a[hit]] - first).tolist(), (point[b[hit]] - first).tolist()):
                    places.setdefault(c.first + i, []).append(tuple(place))
            rows = []
            for i, (doc_id, key, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts)):
                spans = base_spans(text) if text else []
                joined = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
                kinds = [k for _, k, _ in spans]
                mine = places.get(i, [])
                if spans and mine:
                    starts, reach = [a for a, _, _ in spans], list(accumulate((b for _, _, b in spans), max))
                    # outside: every span that starts before the term's end has ended at its start
                    mine = [x for x in mine if not (n := bisect_left(starts, x[2])) or reach[n - 1] <= x[1]]
                rows.append({"rid": rid, "doc_id": doc_id, "text_key": key, **{f"n_{KINDS[k]}": kinds.count(k) for k in range(4)},
                             "base_sha256": hashlib.sha256(joined.encode()).hexdigest(),
                             "base": [{"start": a, "kind": k, "end": b} for a, k, b in spans],
                             "entities": sorted({_entity_hash(k, text[a:b]) for a, k, b in spans}),
                             "places": [dict(zip(("term", "start", "end"), x)) for x in mine]})
                rid += 1
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return (docs.selectExpr("cast(doc_id as bigint) doc_id", "xxhash64(cast(text as string)) text_key", "cast(text as string) text")
            .mapInArrow(run, f"{_BASE}, base {_SPAN}, entities array<bigint>, places {_PLACES}"))


_L, _S = pa.int64(), pa.string()
_ARROW = pa.schema([("rid", _L), ("doc_id", _L), ("text_key", _L), ("n_email", _L), ("n_ip", _L), ("n_card", _L), ("n_phone", _L), ("base_sha256", _S),
                    ("base", pa.list_(pa.struct([("start", _L), ("kind", pa.int32()), ("end", _L)]))),
                    ("entities", pa.list_(_L)), ("places", pa.list_(pa.struct([("term", _L), ("start", _L), ("end", _L)])))])


def term_documents(docs: DataFrame) -> DataFrame:
    """term, n: partial counts of the documents that hold each term (to be summed by term)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def out():
            return pa.RecordBatch.from_arrays([pa.array(terms), pa.array(counts)], names=["term", "n"])

        for batch in batches:
            parts = []
            for c in tb.chunks(batch.column(0)):
                a, b, text = tb.word_spans(c, TERM_SEPARATOR)
                h = tb.span_hash(tb.prefix_hash(tb.LOWER[c.buf]), a, b)
                _, first = np.unique(h ^ tb.mix(text.astype(np.uint64)), return_index=True)
                parts.append(np.unique(h[first].view(np.int64), return_counts=True))
            every = np.concatenate([terms, *[p[0] for p in parts]])
            n = np.concatenate([counts, *[p[1] for p in parts]])
            terms, at = np.unique(every, return_inverse=True)
            counts = np.bincount(at, weights=n, minlength=len(terms)).astype(np.int64)
            if len(terms) > TASK_TERMS:
                yield out()
                terms, counts = terms[:0], counts[:0]
        yield out()

    return docs.selectExpr("cast(text as string) text").mapInArrow(run, "term bigint, n bigint")


def find_private(docs: DataFrame, plan: DisclosurePlan = DisclosurePlan()) -> DataFrame:
    """Base and term spans of each row's whole text; one row per input row.

    Columns: rid (a number of the row), doc_id, text_key (hash of the text), n_email, n_ip, n_card, n_phone, base_sha256,
    spans (``kind:start:end`` by start, then kind; code points, end exclusive) and found
    (array of start, kind number, end, remove).

    Null or empty text: no spans. A null doc_id stays null; repeated rows count as
    documents and return each; an empty table gives an empty result. Extra columns are not
    read. Texts are never cut. A term that gives a value away is a span at all its places
    outside base spans, in the documents that state the value, or with ``plan.everywhere``
    in all.
    """
    stated = materialize(entity_documents(docs).groupBy("entity", "term").agg(F.sum("n").alias("n_entity")))
    counted = stated.where("term is null").drop("term")
    total = F.lit(float(max(1, counted.where("entity is null").agg(F.sum("n_entity")).first()[0] or 0)))
    # what every document holds carries no information: nothing gives it away
    known = counted.where(F.col("entity").isNotNull() & (F.col("n_entity") < total))
    entities = known.where(F.col("n_entity") >= plan.min_docs)
    both = entity_terms(docs, _thin(entities.select("entity"))).groupBy("entity", "term").agg(F.sum("n").alias("n_both"))
    parts = stated.where("term is not null").select("entity", "term", F.col("n_entity").alias("n_both"))     # a part stands wherever its value does
    both = both.where(F.col("n_both") >= plan.min_docs).join(entities, "entity").unionByName(parts.join(known, "entity"))
    both = materialize(both.groupBy("entity", "term").agg(F.max("n_both").alias("n_both"), F.max("n_entity").alias("n_entity")))
    terms = both.select("term").distinct()
    counts = term_documents(docs)
    if terms.count() <= BROADCAST_TERMS:
        counts = counts.join(F.broadcast(terms), "term", "left_semi")
    counts = counts.groupBy("term").agg(F.sum("n").alias("n_term"))
    pmi = F.log2(F.col("n_both") * total / (F.col("n_term") * F.col("n_entity")))
    given = (both.join(counts, "term").withColumn("disclosure", pmi / F.log2(total / F.col("n_entity")))
             .where(F.col("disclosure") >= plan.generalise).select("entity", "term", "disclosure"))
    if plan.everywhere:
        given = given.groupBy("term").agg(F.max("disclosure").alias("disclosure"))
    given = materialize(given)
    base = materialize(find_base(docs, _thin(given.select("term").distinct())))
    places = base.where(F.size("places") > 0).select("rid", "entities", F.explode("places").alias("p")).join(given, F.col("p.term") == F.col("term"))
    if not plan.everywhere:
        places = places.where(F.array_contains("entities", F.col("entity")))
    hits = (places.groupBy("rid", "p").agg(F.max("disclosure").alias("disclosure"))
            .groupBy("rid").agg(F.collect_list(F.struct(
                F.col("p.start").alias("start"), F.lit(4).alias("kind"), F.col("p.end").alias("end"),
                (F.col("disclosure") >= plan.remove).alias("remove"))).alias("terms")))
    mine = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.lit(False).alias("remove")))
    found = F.array_sort(F.concat(mine, F.coalesce("terms", F.array().cast("array<struct<start:bigint,kind:int,end:bigint,remove:boolean>>"))))
    names = F.array(*[F.lit(k) for k in KINDS])
    text = F.array_join(F.transform("found", lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")
    return (base.join(hits, "rid", "left").withColumn("found", found).withColumn("spans", text)
            .select("rid", "doc_id", "text_key", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "found"))


def sanitise(text: str, found: list[tuple[int, int, int, bool]]) -> str:
    """The text with personal data and generalised terms replaced by their kind, and removed terms left out."""
    out, at = [], 0
    for start, kind, end, remove in found:
        if start < at:   # lies in a span already replaced
            start = at
            if end <= at:
                continue
        out += [text[at:start], "" if remove else f"[{KINDS[kind].upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def sanitise_documents(docs: DataFrame, plan: DisclosurePlan = DisclosurePlan()) -> DataFrame:
    """The rows, with all their columns, their texts sanitised and n_chars (where there is one) counted anew.

    Null texts stay null. Rows of the same doc_id and text get the same spans.
    """
    spans = (find_private(docs, plan).where(F.size("found") > 0).dropDuplicates(["doc_id", "text_key"])
             .select(F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("doc_id").isNull().alias("_no_id"), F.col("text_key").alias("_key"), F.col("found").alias("_found")))
    id_ = F.col("doc_id").cast("bigint")
    joined = docs.join(spans, (F.coalesce(id_, F.lit(0)) == F.col("_id")) & (id_.isNull() == F.col("_no_id"))
                       & (F.xxhash64(F.col("text").cast("string")) == F.col("_key")), "left")
    rows = joined.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("kept"), F.col("text").cast("string").alias("text"), F.col("_found").alias("found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            found = batch.column(2)
            hit = np.flatnonzero(np.asarray(found.is_valid())).tolist()
            new = {i: sanitise(texts[i].as_py(), [(s["start"], s["kind"], s["end"], s["remove"]) for s in found[i].as_py()]) for i in hit}
            column = pa.array([new.get(i) for i in range(batch.num_rows)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), column], names=["kept", "changed"])

    out = rows.mapInArrow(run, T.StructType([rows.schema["kept"], T.StructField("changed", T.StringType())]))
    text = F.coalesce("changed", "kept.text")
    columns = {c: F.col(f"kept.`{c}`") for c in docs.columns} | {"text": text}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("changed").isNotNull(), F.length("changed")).otherwise(F.col("kept.n_chars")).cast(docs.schema["n_chars"].dataType)
    return out.select(*[v.alias(k) for k, v in columns.items()])
