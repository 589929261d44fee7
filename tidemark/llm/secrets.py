"""Secret scans with DataFrame functions only: a trigram inverted index chooses the documents, regexes verify them.

Each rule's regex is turned into a Boolean query over trigrams (letters folded): alternatives, one of which
any text with a match holds entirely. Posting lists lead from each trigram of the rules to the
documents that hold it, sorted, and a frequent trigram's list lies in parts. A query's postings are intersected by
one aggregation over the lists, and only the documents that are left are searched for the rule. A rule without
mandatory trigrams scans every text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SMALL, discard, fresh, row_key, sieve, staged
from tidemark.llm.regexes import MOST, Either, Repeat, Run, parsed, spelt


@dataclass(frozen=True)
class SecretRule:
    """A match counts if its group (0: all of it) has at least `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    fold: bool = False


#: The base kinds come first. Where a run fails by its length alone, the length is in the regex; a jwt's header is
#: bounded, so that runs of its first letters are not read again from each of them to their end.
RULES = (
    SecretRule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=2, least=6, fold=True),
    SecretRule("access", r"AKIA[A-Z0-9]{16,}"),
    SecretRule("hex", r"[0-9a-f]{24,}"),
    SecretRule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    SecretRule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    SecretRule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    SecretRule("google", r"AIza[A-Za-z0-9_-]{35,}"),
    SecretRule("stripe", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]{8,400}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    SecretRule("bearer", r"bearer\x20[A-Za-z0-9._~+/=-]{20,}", fold=True),
    SecretRule("login", r"://[A-Za-z0-9._~%-]{1,64}:[^\x00-\x20:/@]{1,64}@"),
)
BASE = ("assign", "access", "hex")

Query = frozenset  # of alternatives, each a frozenset of trigrams; one empty alternative: any text
ANY: Query = frozenset([frozenset()])


def _all(a: Query, b: Query) -> Query:
    return _least(frozenset(x | y for x in a for y in b))


def _least(q: Query) -> Query:
    return frozenset(x for x in q if not any(y < x for y in q))


def _of_strings(strings: set[str]) -> Query:
    """For each string trigrams side by side over its whole length; those between them would add little."""
    return _least(frozenset(frozenset(s[i : i + 3] for i in [*range(0, len(s) - 2, 3), len(s) - 3] if i >= 0) for s in strings))


def _query(part: Run) -> Query:
    out, run = ANY, {""}
    for item in part.items:
        own = spelt(item)
        if own is not None and "" in own:  # what may be missing ends the run
            own = {""}
            out, run = _all(out, _of_strings(run)), {""}
        if own is not None and len(run) * len(own) <= MOST:
            run = {a + b for a in run for b in own}
            continue
        out = _all(out, _of_strings(run))
        run = own if own is not None else {""}
        if isinstance(item, Run):
            out = _all(out, _query(item))
        elif isinstance(item, Either):
            out = _all(out, _least(frozenset().union(*[_query(x) for x in item.items])))
        elif isinstance(item, Repeat) and item.least > 0:
            out = _all(out, _query(item.item))
    return _all(out, _of_strings(run))


def trigram_query(pattern: str) -> Query:
    """Alternatives of trigrams, over folded text, one of which any text with a match holds entirely."""
    return _query(parsed(pattern))


def _numbers(rules: tuple[SecretRule, ...]) -> dict[str, int]:
    """The trigrams that the rules' queries name, numbered."""
    return {t: i for i, t in enumerate(sorted({t for r in rules for alternative in trigram_query(r.pattern) for t in alternative}))}


LIST_PARTS = 64  # of a trigram's posting list
_BITS = 62


def posting_lists(texts: DataFrame, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """The inverted index of `texts` (key, body): rows (gram, key), for each trigram of the rules the sorted keys of the texts that hold it.

    A list lies in up to LIST_PARTS sorted runs, so a trigram that most texts hold is no task's alone.
    """
    number = _numbers(rules)
    named, longs = list(number), []
    for at in range(0, len(named), _BITS):  # whether a text holds each trigram, as bits, which compile to short code
        longs.append(reduce(_plus, [F.contains("low", F.lit(t)).cast("long") * F.lit(1 << i) for i, t in enumerate(named[at : at + _BITS])]))
    held = F.filter(F.sequence(F.lit(0), F.lit(len(named) - 1)), lambda i: F.getbit(F.col("bits")[(i / _BITS).cast("int")], i % _BITS) == 1)
    rows = texts.select("key", F.lower("body").alias("low")).select("key", F.array(*longs).alias("bits")).select(F.explode(held).alias("gram"), "key")
    part = F.pmod(F.xxhash64("key"), F.lit(LIST_PARTS))
    return rows.repartition("gram", part).sortWithinPartitions("gram", "key")


def candidates(index: DataFrame, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """(key, rules): for each text in the index the numbers of the rules whose queries its postings satisfy.

    An alternative is met by the keys in all of its trigrams' lists: each list sets one bit of a key's mask.
    """
    number, terms = _numbers(rules), []
    for r, rule in enumerate(rules):
        for a, alternative in enumerate(sorted(map(sorted, trigram_query(rule.pattern)))):
            terms += [f"({r}, {a}, {number[t]}, {1 << i}L, {(1 << len(alternative)) - 1}L)" for i, t in enumerate(alternative)]
    query = index.sparkSession.sql(f"select col1 as rule, col2 as alternative, col3 as gram, col4 as bit, col5 as full from values {', '.join(terms)}")
    met = index.join(F.broadcast(query), "gram").repartition("key")  # a row for each trigram of a rule
    met = met.groupBy("key", "rule", "alternative").agg(F.bit_or("bit").alias("bits"), F.first("full").alias("full")).filter("bits = full")
    return met.groupBy("key").agg(F.collect_set("rule").alias("rules"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def _running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Running sums (or maxima) of an array of integers from 0: each step combines with what stands 1, 2, 4, .. places before."""

    def step(acc: Column, k: Column) -> Column:
        back = F.pow(F.lit(2), k).cast("int")
        return F.zip_with(acc, F.concat(F.array_repeat(F.lit(0), back), F.slice(acc, F.lit(1), F.size(acc) - back)), combine)

    def over(v: Column) -> Column:
        steps = F.when(F.size(v) > 1, F.sequence(F.lit(0), F.floor(F.log2(F.size(v) - 1)).cast("int"))).otherwise(F.array().cast("array<int>"))
        return F.aggregate(steps, v, step)

    return _let(values, over)


def _plus(a: Column, b: Column) -> Column:
    return a + b


def _largest(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


_SPAN = "array<struct<start:int,kind_no:int,end:int>>"


def _matches(text: str, rule: SecretRule, order: int) -> Column:
    """Spans of the leftmost non-overlapping matches: lengths of the matches and of what lies between them add up to their ends."""
    pattern = f"(?i){rule.pattern}" if rule.fold else rule.pattern
    lengths = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)
    counted = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.group)), F.length) if rule.group else F.lit(None).cast("array<int>")
    raw = F.struct(lengths.alias("n"), F.transform(F.split(F.col(text), pattern, -1), F.length).alias("gap"), counted.alias("c"))

    def spans(found: Column) -> Column:
        ends = _running(F.zip_with(F.slice(found["gap"], F.lit(1), F.size(found["n"])), found["n"], _plus), _plus)
        rows = F.arrays_zip(ends.alias("end"), found["n"].alias("n"), (found["c"] if rule.group else found["n"]).alias("c"))
        if rule.least:
            rows = F.filter(rows, lambda x: x["c"] >= rule.least)
        return F.transform(rows, lambda x: F.struct((x["end"] - x["n"]).alias("start"), F.lit(order).alias("kind_no"), x["end"].alias("end")))

    return _let(raw, spans).cast(_SPAN)


def find_secrets(docs: DataFrame, rules: tuple[SecretRule, ...] = RULES, column: str = "secrets") -> DataFrame:
    """docs with one more column: spans (kind, start, end in code points, end exclusive) by start, then order of the rules.

    Matches of one rule do not overlap; those of different rules may. A null or empty text has none; null and
    repeated ids and repeated rows are rows like others; no rows give none; a very long text takes time in
    proportion to its length (times the logarithm of its matches). Columns of docs keep their names, whatever they are.
    The postings' keys are 128-bit digests of id and text; texts meet the rules that they may match in one
    join by key, which moves each text once, unless the candidates are few and counted to be so.
    """
    body, key, may = fresh(docs, "body"), fresh(docs, "key"), fresh(docs, "may")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    named = row_key(docs)
    indexed = [i for i, r in enumerate(rules) if trigram_query(r.pattern) != ANY]
    out = docs.withColumn(body, text).withColumn(key, named)
    if indexed:
        index = staged(posting_lists(docs.select(named.alias("key"), text.alias("body")), rules), "postings")
        left = staged(candidates(index, rules).select(F.col("key").alias(key), F.col("rules").alias(may)), "candidates")
        discard(index)
        if left.count() <= SMALL:
            out = out.join(F.broadcast(left), key, "left")
        else:  # only texts that may be candidates move
            some, others = sieve(out, key, left.select(key))
            out = some.join(left.hint("shuffle_hash"), key, "left").unionByName(others, allowMissingColumns=True)
    else:
        out = out.withColumn(may, F.array().cast("array<int>"))
    none = F.array().cast(_SPAN)
    each = [F.when(F.array_contains(may, i), _matches(body, r, i)).otherwise(none) if i in indexed else _matches(body, r, i) for i, r in enumerate(rules)]
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    spans = F.transform(F.array_sort(F.concat(none, *each)), lambda s: F.struct(kinds[s["kind_no"]].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return out.withColumn(column, spans).select(*[F.col(f"`{c}`") for c in docs.columns if c != column], column)


def written(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _same(kind: str):
    return lambda x: x == kind


def secret_report(docs: DataFrame, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """The digest, a row for each row of docs: doc_id, counts of the base kinds, a hash of their spans, and all spans as text.

    Null and empty texts have counts of 0, the hash of nothing and no spans; null and repeated ids give rows of their
    own; no rows give none; further columns of docs are not looked at.
    """
    found = find_secrets(docs.select("doc_id", "text"), rules, "secrets").select("doc_id", "secrets")
    spans = F.col("secrets")
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE))
    counts = [F.size(F.filter(spans["kind"], _same(k))).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(spans).alias("spans"))


_BLOCK = 1024  # code points; a text is cut into blocks once, so that a piece is found without reading the text before it


def _without(text: Column, spans: Column, mark: str) -> Column:
    """The text with `mark` for each run of overlapping spans."""

    def piece(blocks: Column, first: Column, past: Column) -> Column:
        def part(i: Column) -> Column:
            a = F.greatest(first - i * _BLOCK, F.lit(0))
            return blocks[i].substr(a + 1, F.least(past - i * _BLOCK, F.lit(_BLOCK)) - a)

        numbers = F.sequence((first / _BLOCK).cast("int"), ((past - 1) / _BLOCK).cast("int"))
        return F.when(past > first, F.array_join(F.transform(numbers, part), "")).otherwise("")

    def cut(x: Column) -> Column:
        # each span with the furthest end before it; those that start there or later begin a run
        before = F.slice(F.concat(F.array(F.lit(0)), x["reach"]), F.lit(1), F.size(x["reach"]))
        heads = F.filter(F.arrays_zip(spans["start"].alias("start"), before.alias("before")), lambda h: h["start"] >= h["before"])
        kept = F.transform(heads, lambda h: F.concat(piece(x["blocks"], h["before"], h["start"]), F.lit(mark)))
        last = F.element_at(x["reach"], -1)
        return F.concat(F.array_join(kept, ""), piece(x["blocks"], last, F.length(text)))

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_BLOCK}}}"), F.lit(0))
    return _let(F.struct(blocks.alias("blocks"), _running(spans["end"], _largest).alias("reach")), cut)


def redact_secrets(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """docs with each secret (overlapping ones as one) of a text replaced by `mark`; n_chars follows where docs have it.

    Rows without secrets stay as they are, null and empty texts too; repeated rows each get the same text; no rows give none.
    """
    held = fresh(docs, "found")
    found = find_secrets(docs, column=held)
    touched = F.size(held) > 0
    out = found.withColumn("text", F.when(touched, _without(F.col("text"), F.col(held), mark)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(touched, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
