"""Secret scans by a trigram inverted index (built-in functions only).

From each rule's regular expression a Boolean trigram query is derived. An inverted index has a posting list for each
trigram of these queries and block of documents; the queries intersect and unite the lists, and what they leave is
verified with the regular expressions. Rules without a mandatory trigram are matched against every text.

Defined cases: a null text counts as empty. Rows without a doc_id cannot be indexed and are verified with every rule.
Repeated rows are each verified and returned; the index holds an id once. Other columns are ignored. Spans count code
points, the end exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexapla.llm.common import let, written
from hexapla.llm.trigrams import ANY, trigram_query, trigrams_of

#: Documents of 2^BLOCK_BITS successive ids share posting lists, so that a list has so many ids at most.
BLOCK_BITS = 12
#: The prefix sums of match lengths are taken in runs of so many.
RUN = 256


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and not overlapping, of which those with ``least`` characters in ``group`` stay."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The contract's kinds, in its order. A run of hex digits is matched only from 32 on, which finds the same spans.
BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}"),
)
#: Kinds that the operator adds.
MORE_RULES = (
    Rule("private", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[0-9A-Za-z-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}"),
    Rule("stripe", r"[rs]k_live_[0-9A-Za-z]{16,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("login", r"[a-z][a-z0-9+.-]{1,20}://[A-Za-z0-9._~%-]+:[A-Za-z0-9._~%!$&'()*+,;=-]+@"),
)
RULES = BASE_RULES + MORE_RULES


def _queries(rules: tuple[Rule, ...]) -> dict[str, object]:
    return {r.kind: trigram_query(r.pattern) for r in rules}


def trigram_index(docs: DataFrame, trigrams: list[str], block_bits: int = BLOCK_BITS) -> DataFrame:
    """(trigram, block, postings): the ids of the block whose text has the trigram, in lower case."""
    has = let(F.lower("text"), lambda low: F.filter(F.array(*[F.lit(t) for t in trigrams]), lambda t: low.contains(t)))
    rows = docs.filter("doc_id is not null and text is not null").select("doc_id", F.explode(has).alias("trigram"))
    block = F.call_function("shiftright", F.col("doc_id"), F.lit(block_bits))
    return rows.groupBy("trigram", block.alias("block")).agg(F.collect_set("doc_id").alias("postings"))


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, kinds): for each document the indexed rules whose query it fulfils."""
    none = F.array().cast("array<bigint>")
    lists = F.map_from_entries(F.collect_list(F.struct("trigram", "postings")))
    blocks = index.groupBy("block").agg(lists.alias("lists"))

    def answer(query) -> Column:
        if isinstance(query, str):
            return F.coalesce(F.try_element_at("lists", F.lit(query)), none)
        parts = [answer(p) for p in query[1]]
        out = parts[0]
        for p in parts[1:]:
            out = F.array_intersect(out, p) if query[0] == "and" else F.array_union(out, p)
        return out

    found = [F.struct(F.lit(k).alias("kind"), answer(q).alias("ids")) for k, q in _queries(rules).items() if q != ANY]
    pairs = blocks.select(F.explode(F.array(*found)).alias("f")).select("f.kind", F.explode("f.ids").alias("doc_id"))
    return pairs.groupBy("doc_id").agg(F.array_sort(F.collect_set("kind")).alias("kinds"))


def _running(lengths: Column) -> Column:
    """Sums of all lengths before each one, in runs, so that many matches don't cost their square."""
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)

    def of(a: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / RUN).cast("int")), lambda b: total(F.slice(a, b * RUN + 1, F.lit(RUN))))
        before = lambda r: F.transform(r, lambda _, b: total(F.slice(r, F.lit(1), b)))
        return let(let(runs, before), lambda p: F.transform(a, lambda _, i: F.get(p, F.floor(i / RUN).cast("int")) + total(F.slice(a, i - i % RUN + 1, i % RUN))))

    return let(lengths, of)


def spans(text: Column, rule: Rule, order: int) -> Column:
    """The rule's spans in a text, from the matches and the pieces between them."""
    kind = "array<struct<start:bigint,ord:int,end:bigint,kind:string>>"
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    measured = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else None

    def located(m: Column) -> Column:
        pieces = F.split(text, rule.pattern)
        steps = F.zip_with(F.slice(pieces, F.lit(1), F.size(m)), m, lambda a, b: (F.length(a) + F.length(b)).cast("long"))

        def one(before: Column, i: Column) -> Column:
            return F.struct(before.alias("b"), i.alias("i"))

        def with_groups(g: Column, p: Column) -> Column:
            found = F.transform(let(steps, _running), one)
            full = F.transform(found, lambda x: F.struct(
                (x["b"] + F.length(F.get(p, x["i"]))).cast("long").alias("start"), F.lit(order).alias("ord"),
                (x["b"] + F.length(F.get(p, x["i"])) + F.length(F.get(m, x["i"]))).cast("long").alias("end"),
                F.lit(rule.kind).alias("kind"), F.length(F.get(g, x["i"])).alias("n")))
            return F.transform(F.filter(full, lambda x: x["n"] >= rule.least), lambda x: F.struct(x["start"].alias("start"), x["ord"].alias("ord"), x["end"].alias("end"), x["kind"].alias("kind")))

        return let(pieces, lambda p: let(measured, lambda g: with_groups(g, p)) if measured is not None else with_groups(m, p))

    return let(matches, lambda m: F.when(F.size(m) == 0, F.array().cast(kind)).otherwise(located(m).cast(kind)))


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES, block_bits: int = BLOCK_BITS) -> DataFrame:
    """``docs`` with ``spans``: array of (start, ord, end, kind), sorted by start and the rules' order. A column of that name
    is replaced; all others stay, whatever their names.

    The candidates are written to the shared folder; Spark broadcasts them if their known size allows it, and joins by
    shuffle if not.
    """
    queries = _queries(rules)
    indexed = [k for k, q in queries.items() if q != ANY]
    text = F.coalesce(F.col("own.text"), F.lit(""))
    own = docs.alias("own")
    if indexed:
        index = trigram_index(docs, sorted({t for k in indexed for t in trigrams_of(queries[k])}), block_bits)
        found = written(candidates(index, rules), "secret-candidates").alias("found")
        own = own.join(found, F.col("own.doc_id") == F.col("found.doc_id"), "left")
    every = []
    for i, r in enumerate(rules):
        s = spans(text, r, i)
        if r.kind in indexed:
            wanted = F.col("own.doc_id").isNull() | F.coalesce(F.array_contains("found.kinds", r.kind), F.lit(False))
            s = F.when(wanted, s).otherwise(F.array().cast("array<struct<start:bigint,ord:int,end:bigint,kind:string>>"))
        every.append(s)
    return own.select(*[F.col(f"own.`{c}`") for c in docs.columns if c != "spans"], F.sort_array(F.concat(*every)).alias("spans"))


def digest(spans_: Column) -> Column:
    """kind:start:end of the spans in their order, joined by commas."""
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scanned(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, a count for each base kind, base_sha256, spans) of each row."""
    found = secret_spans(docs.select("doc_id", "text"), rules).select("doc_id", "spans")
    count = lambda i: F.size(F.filter("spans", lambda s: s["ord"] == i)).cast("long")
    base = F.filter("spans", lambda s: s["ord"] < len(BASE_RULES))
    return found.select(
        "doc_id", *[count(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE_RULES)],
        F.sha2(digest(base).cast("binary"), 256).alias("base_sha256"), digest(F.col("spans")).alias("spans"),
    )


def redacted(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> DataFrame:
    """``docs`` with each run of overlapping spans in ``text`` replaced by ``mark``, and n_chars, if there, renewed.

    Rows without secrets are returned as they are; null texts stay null.
    """
    columns = docs.columns
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    found = secret_spans(docs.select("doc_id", "text", row.alias("row")), rules)

    def cleaned(s: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            gap = F.when(x["start"] >= acc["at"], F.concat(F.substring("text", acc["at"] + 1, x["start"] - acc["at"]), F.lit(mark))).otherwise(F.lit(""))
            return F.struct(F.concat(acc["out"], F.array(gap)).alias("out"), F.greatest(acc["at"], x["end"]).alias("at"))

        start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).cast("long").alias("at"))
        return F.aggregate(s, start, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring("text", acc["at"] + 1, F.lit(2**31 - 1))))

    some = F.size("spans") > 0
    out = found.withColumn("clean", F.when(some, cleaned(F.col("spans"))).otherwise(F.col("text")))
    new = {"text": F.col("clean")}
    if "n_chars" in columns:
        new["n_chars"] = F.when(some, F.length("clean").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    return out.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in columns])
