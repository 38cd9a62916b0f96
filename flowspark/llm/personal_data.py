"""Personal data: fixed forms as seeds, and bootstrapped extraction of identifiers that only their context gives away.

1. Every whole text is searched for emails, addresses, cards and phones by their fixed forms (the base spans, which always
   stay), and for mentions: the base spans and every other token that looks like an identifier (digit groups, codes, tokens
   with an at sign, spelt-out at signs).
2. A mention's patterns are the words around it: one or two before, one after, one on either side. Patterns and distinct
   values form a graph; values that have a fixed form somewhere are its seeds.
3. Spark scores the graph in `ROUNDS` rounds. A pattern's confidence for a kind is the share of that kind among the distinct
   values seen in it, smoothed by its support: codes, other kinds and unknown values all speak against it. A value's
   confidence is that not all of its confident patterns err (1 - product of 1 - confidence). Values found in one round
   support further patterns in the next.
4. Mentions with no fixed form whose value is confident, and whose shape fits the kind, are spans as well.

Only mentions travel, a few for each document. Aggregates by pattern and value are partial before each shuffle, and joins
are between written tables, so that adaptive execution can split a hot pattern.

Base matches are leftmost and do not overlap within a kind; they are searched by possessive patterns in linear time, which
find what the plain ones find. Places are code points, ends exclusive.

Defined results: null and empty texts have no spans; null ids are kept; repeated rows are judged each on their own, but as
graph nodes equal values count once. An empty table gives an empty table. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowspark.session import materialize

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
#: A pattern or value is confident from here on.
CONFIDENT = 0.8
#: A pattern needs this much support of a kind, and as if SMOOTH further values spoke against it.
SUPPORT = 8
SMOOTH = 2
#: Characters of context looked at on either side.
CONTEXT = 80
#: Mentions of one text in a row; a text with more gets several rows.
MENTIONS = 4096

# Fixed forms; possessive, and begun where a run begins, so that a long run is read once.
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
_EMAIL_HERE = re.compile(rf"{_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++")
_EMAIL = re.compile(rf"(?<!{_LOCAL}){_EMAIL_HERE.pattern}")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?+[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
_DIGITS = re.compile(r"[+(]*[0-9][0-9().:/-]*[,;]?")
_SPELT = re.compile(r"[\[(]at[\])]", re.I)
_SPELT_LEFT = re.compile(rf"({_LOCAL}{{1,64}}) ?\Z")
_SPELT_RIGHT = re.compile(rf" ?{_LABEL}{{1,64}}(?: ?(?:\.|[\[(]dot[\])]) ?{_LABEL}{{1,64}}){{1,8}}", re.I)
_EDGE = "\"'`.,;:!?<>[]{}|*"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    if "@" not in text:
        return
    found = _EMAIL.search(text)
    while found:
        yield found.span()
        end = found.end()
        found = _EMAIL_HERE.match(text, end) or _EMAIL.search(text, end)  # a match may begin where one ends


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p) <= 255 for p in (p.lstrip("0") or "0" for p in m.group().split("."))):
            yield m.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" not in text:
        return
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            yield m.span()


FORMS = dict(zip(KINDS, (emails, ips, cards, phones), strict=True))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of everything with a fixed form, by kind as listed, then start."""
    return [(kind, a, b) for kind in KINDS for a, b in FORMS[kind](text)]


def _value(text: str) -> str:
    """What a mention names, whatever its spelling: an email's letters, an address, a number's digits, or a code."""
    if "@" in text:
        return text.lower()
    digits = "".join(c for c in text if "0" <= c <= "9")
    if text.count(".") == 3 and all(c in "0123456789." for c in text):
        return text
    return digits if len(digits) >= 5 and not any(c.isalpha() for c in text) else text


def fits(text: str) -> list[str]:
    """Kinds that a mention without a fixed form may be."""
    if "@" in text:
        return ["email"]
    digits = sum("0" <= c <= "9" for c in text)
    if any(c.isalpha() for c in text):
        return []
    dotted = [p for p in re.split("[.:]", text) if p]
    return (["ip"] if len(dotted) >= 4 else []) + (["card"] if 12 <= digits <= 19 else []) + (["phone"] if 7 <= digits <= 15 else [])


def lookalikes(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, what is named) of tokens that look like identifiers, whatever their form."""
    run: list[int] = []  # digit groups with one blank between are one mention

    def closed():
        a, b = run
        run.clear()
        while b > a and text[b - 1] in _EDGE:
            b -= 1
        if sum("0" <= c <= "9" for c in text[a:b]) >= 5:
            yield a, b, text[a:b]

    for m in _TOKEN.finditer(text):
        a, b = m.span()
        if _DIGITS.fullmatch(m.group()):
            if run and a == run[1] + 1 and text[run[1]] == " ":
                run[1] = b
                continue
            if run:
                yield from closed()
            run[:] = [a, b]
            continue
        if run:
            yield from closed()
        while a < b and text[a] in _EDGE:
            a += 1
        while b > a and text[b - 1] in _EDGE:
            b -= 1
        token = text[a:b]
        if 3 <= len(token) <= 254 and ("@" in token[1:-1] or sum("0" <= c <= "9" for c in token) >= 3):
            yield a, b, token
    if run:
        yield from closed()
    if "at)" in text or "at]" in text or "AT)" in text or "AT]" in text:
        for m in _SPELT.finditer(text):
            left = _SPELT_LEFT.search(text[max(0, m.start() - 65):m.start()])
            right = _SPELT_RIGHT.match(text, m.end())
            if left and right:
                domain = re.sub(r"[\[(]dot[\])]", ".", right.group(), flags=re.I).replace(" ", "")
                yield m.start() - len(left.group()), right.end(), f"{left.group(1)}@{domain}"


def patterns(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns around a span; digits are all alike."""
    def plain(words: str) -> list[str]:
        return re.sub("[0-9]", "0", words.lower()).split()

    left = ["^", "^", *plain(text[max(0, start - CONTEXT):start])]
    right = [*plain(text[end:end + CONTEXT]), "$"]
    one, two, after = left[-1], f"{left[-2]} {left[-1]}", right[0]
    return [f"{one} _", f"{two} _", f"_ {after}", f"{one} _ {after}"]


def mentions(text: str, base: list[tuple[str, int, int]]) -> Iterator[tuple]:
    """(start, end, value, kind or None, kinds that fit, patterns): base spans, and lookalikes that overlap none of them."""
    for kind, a, b in base:
        yield a, b, _value(text[a:b]), kind, [], patterns(text, a, b)
    taken = sorted((a, b) for _, a, b in base)
    i, reach = 0, 0
    for a, b, named in sorted(lookalikes(text)):
        while i < len(taken) and taken[i][0] < b:
            reach = max(reach, taken[i][1])
            i += 1
        if a >= reach:
            yield a, b, _value(named), None, fits(named), patterns(text, a, b)
            reach = max(reach, b)


MENTION = "array<struct<start:long,end:long,value:string,kind:string,fits:array<string>,patterns:array<string>>>"
READ = f"row long, doc_id long, base array<struct<kind:string,start:long,end:long>>, mentions {MENTION}"


def _read(docs: DataFrame) -> DataFrame:
    """A row for each text with its base spans, and rows with its mentions. `row` numbers the texts."""
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    mention = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("value", pa.string()), ("kind", pa.string()),
                                  ("fits", pa.list_(pa.string())), ("patterns", pa.list_(pa.string()))]))
    names = ["start", "end", "value", "kind", "fits", "patterns"]

    def batch(rows):
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), span, mention), strict=True)], names=["row", "doc_id", "base", "mentions"])

    def run(batches):
        number = TaskContext.get().partitionId() << 40  # the rows are written once, so a repeated task may number them anew
        for given in batches:
            rows, size = [], 0
            for doc, text in zip(given.column(0), given.column(1), strict=True):
                text = text.as_py()
                base = base_spans(text)
                rows.append((number, doc.as_py(), [dict(zip(("kind", "start", "end"), b, strict=True)) for b in base], None))
                held = []
                for m in mentions(text, base):
                    held.append(dict(zip(names, m, strict=True)))
                    if len(held) == MENTIONS:
                        yield batch([(number, None, None, held)])
                        held = []
                if held:
                    rows.append((number, None, None, held))
                number += 1
                size += 1 + len(base) + len(held)
                if size > MENTIONS:
                    yield batch(rows)
                    rows, size = [], 0
            if rows:
                yield batch(rows)

    return docs.mapInArrow(run, READ)


def _graph(found: DataFrame) -> DataFrame:
    """Written edges (pattern, value, kind, fits): each pattern with each of its distinct values. kind: that of a seed."""
    # Of several kinds a value may have, the first listed.
    nodes = found.groupBy("value").agg(F.min_by("kind", _order(F.col("kind"))).alias("kind"))
    edges = found.select(F.explode("patterns").alias("pattern"), "value", "fits").groupBy("pattern", "value").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("fits")))).alias("fits"))
    return materialize(materialize(edges, "edges").join(materialize(nodes, "values"), "value"), "graph")


def score(graph: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(pattern, kind, confidence, support) of confident patterns and (value, kind, confidence) of confident values, no seeds among them.

    Each round: patterns from seeds and the values found so far, then values from the confident patterns.
    """
    seeded = graph.groupBy("pattern").agg(F.count(F.lit(1)).alias("values"), *[F.count(F.when(F.col("kind") == k, 1)).cast("double").alias(k) for k in KINDS])
    seeded = materialize(seeded, "seeded").select("pattern", "values", F.explode(F.create_map(*[
        x for k in KINDS for x in (F.lit(k), F.col(k))])).alias("kind", "seeds"))
    open_ = materialize(graph.where("kind IS NULL").select("pattern", "value", "fits"), "open")
    values = None
    for _ in range(rounds):
        held = seeded.withColumn("support", F.col("seeds"))
        if values is not None:
            more = open_.join(values, "value").groupBy("pattern", "kind").agg(F.sum("confidence").alias("more"))
            held = seeded.join(more, ["pattern", "kind"], "left").withColumn("support", F.col("seeds") + F.coalesce("more", F.lit(0.0)))
        confident = materialize(held.withColumn("confidence", F.col("support") / (F.col("values") + SMOOTH)).where(
            (F.col("confidence") >= CONFIDENT) & (F.col("support") >= SUPPORT)).select("pattern", "kind", "confidence", "support"), "patterns")
        doubt = open_.join(confident, "pattern").where(F.array_contains("fits", F.col("kind"))).groupBy("value", "kind").agg(
            F.round(1 - F.exp(F.sum(F.log1p(-F.col("confidence")))), 12).alias("confidence"))
        values = materialize(doubt.where(F.col("confidence") >= CONFIDENT), "found")
    return confident, values


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, base and spans, both arrays of (kind, start, end) by kind as listed, then start."""
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    read = materialize(_read(source), "mentions")
    found = read.where("mentions IS NOT NULL").select("row", F.explode("mentions").alias("m")).select("row", "m.*")
    graph = _graph(found)
    _, values = score(graph)

    # Open mentions of confident values, and of values that have a fixed form elsewhere.
    known = graph.where("kind IS NOT NULL").select("value", "kind").distinct().withColumn("confidence", F.lit(1.0)).unionByName(values)
    open_ = found.where("kind IS NULL").drop("kind", "patterns")
    new = open_.join(materialize(known, "known"), "value").where(F.array_contains("fits", F.col("kind"))).groupBy("row", "start", "end").agg(
        F.max_by("kind", F.struct("confidence", -_order(F.col("kind")))).alias("kind"))
    new = materialize(new, "new").groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("_new"))
    sort = lambda spans: F.array_sort(spans, lambda a, b: F.when(_key(a) < _key(b), -1).when(_key(a) > _key(b), 1).otherwise(0))
    return read.where("base IS NOT NULL").drop("mentions").join(new, "row", "left").select(
        "doc_id", "base", F.when(F.col("_new").isNull(), F.col("base")).otherwise(sort(F.concat("base", "_new"))).alias("spans"))


def _order(kind):
    """Place of a kind in KINDS; null for none."""
    place = F.lit(None).cast("int")
    for i, k in enumerate(KINDS):
        place = F.when(kind == k, i).otherwise(place)
    return place


def _key(span):
    return F.struct(_order(span.kind), span.start, span.end)


def learned_patterns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(pattern, kind, confidence, support) of the patterns that the corpus teaches; `_` stands for the identifier."""
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    found = materialize(_read(source), "mentions").where("mentions IS NOT NULL").select(F.explode("mentions").alias("m")).select("m.*")
    return score(_graph(found))[0]


def written(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def op13_personal_data(spark, sf_dir: str) -> DataFrame:
    found = personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))

    def count(kind):
        return F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS), F.sha2(F.encode(written("base"), "utf-8"), 256).alias("base_sha256"), written("spans").alias("spans"))
