"""Secrets in texts: postings of trigrams name candidates, regular expressions verify them.

Built-in functions only.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squadlake.llm.common import kept, small_side, whole
from squadlake.llm.trigrams import trigram_query


class Rule(NamedTuple):
    kind: str
    pattern: str
    group: int  # whose length counts
    least: int  # characters of it; shorter matches are dropped, and what they span stays spent


#: The kinds of the contract first, in its order, then well-known token formats.
RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
    Rule("github", r"gh[opsu]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abp]-[A-Za-z0-9-]+", 0, 15),
    Rule("google", r"AIza[0-9A-Za-z_-]+", 0, 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
)
BASE = 3
MARK = "[SECRET]"
#: Matches added up at once.
RUN = 128
SPANS = "array<struct<start:int,kind:int,end:int>>"


def rule_spans(text: Column, number: int, rule: Rule) -> Column:
    """Start, rule's number and end of each match: lengths of matches and of what lies between, added up."""
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    values = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else matches
    # After the last match there is a gap and no match.
    lengths = F.zip_with(
        F.split(text, rule.pattern, -1),
        F.zip_with(matches, values, lambda m, v: F.struct(F.char_length(m).alias("match"), F.char_length(v).alias("value"))),
        lambda gap, m: F.struct(
            F.char_length(gap).alias("gap"), m["match"].alias("match"), m["value"].alias("value")
        ),
    )

    def add(so_far: Column, part: Column) -> Column:
        start = so_far["at"] + part["gap"]
        end = start + part["match"]
        span = F.struct(start.alias("start"), F.lit(number).alias("kind"), end.alias("end"))
        return F.when(
            part["value"] >= rule.least,
            F.struct(end.alias("at"), F.concat(so_far["spans"], F.array(span)).alias("spans")),
        ).otherwise(F.struct(F.coalesce(end, so_far["at"]).alias("at"), so_far["spans"].alias("spans")))

    def begun(at: Column) -> Column:
        return F.struct(at.alias("at"), F.array().cast(SPANS).alias("spans"))

    def in_runs(parts: Column) -> Column:
        """An array that grows is copied at each step, so runs of RUN parts are added up first, and then within each."""
        runs = _in_runs(parts)
        sizes = F.transform(
            runs,
            lambda run: F.aggregate(run, F.lit(0), lambda n, p: n + p["gap"] + F.coalesce(p["match"], F.lit(0))),
        )
        starts = F.aggregate(
            sizes,
            F.array(F.lit(0)),
            lambda so_far, n: F.concat(so_far, F.array(F.element_at(so_far, -1) + n)),
        )
        placed = F.zip_with(runs, F.slice(starts, 1, F.size(runs)), lambda run, at: F.struct(run.alias("run"), at.alias("at")))
        return F.flatten(
            F.transform(placed, lambda p: F.aggregate(p["run"], begun(p["at"]), add, lambda s: s["spans"]))
        )

    # A one-element array in between, so that the lengths are made once.
    spans = F.flatten(F.transform(F.array(lengths), in_runs))
    return F.when(F.regexp_like(text, pattern), spans).otherwise(F.array().cast(SPANS))


def postings(docs: DataFrame, grams: list[str]) -> DataFrame:
    """``gram, key``: the inverted index, for the trigrams that rules ask for.

    ``key`` is a hash of the text. Texts that share it share postings, which can only add
    candidates, as every candidate is verified on its own text.
    """
    lower = F.lower(whole(F.col("text")))  # folds at least A-Z
    held = F.array_compact(F.array(*(F.when(F.contains(lower, F.lit(g)), F.lit(g)) for g in grams)))
    return docs.select(text_key().alias("key"), F.explode(held).alias("gram")).distinct()


def text_key() -> Column:
    return F.xxhash64(whole(F.col("text")))


def candidates(index: DataFrame, queries: dict[int, list[frozenset[str]]]) -> DataFrame:
    """``key, rules``: for each text, a bitmap of the rules of which all trigrams of a clause are there."""
    clauses = [(rule, n, gram) for rule, each in queries.items() for n, c in enumerate(each) for gram in sorted(c)]
    sizes = [(rule, n, len(c)) for rule, each in queries.items() for n, c in enumerate(each)]
    # As many rows as the rules' trigrams.
    asked = F.explode(
        F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(n).alias("clause"), F.lit(g).alias("gram")) for r, n, g in clauses))
    )
    need = reduce(
        lambda rest, x: F.when((F.col("rule") == x[0]) & (F.col("clause") == x[1]), x[2]).otherwise(rest),
        sizes,
        F.lit(None),
    )
    wanted = index.sparkSession.range(1).select(asked.alias("q")).select("q.*")
    return (
        index.join(F.broadcast(wanted), "gram")
        .groupBy("key", "rule", "clause")
        .agg(F.count("*").alias("held"))
        .where(F.col("held") == need)
        .groupBy("key")
        .agg(F.expr("bit_or(shiftleft(1, rule))").alias("rules"))
    )


def find_secrets(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, carried: list[str] | None = None
) -> DataFrame:
    """``row`` (the document, all its columns or those ``carried``) and ``spans`` (start, rule's number, end), sorted.

    Rules with mandatory trigrams are verified on the texts their postings leave, the others
    scan every text. Matches are leftmost and don't overlap within a rule. Positions
    count code points. A null text is empty, a null id is kept, repeated rows are rows of their
    own, an empty table gives an empty result.
    """
    queries = {n: trigram_query(rule.pattern) for n, rule in enumerate(rules)}
    indexed = {n: q for n, q in queries.items() if q}
    grams = sorted(set().union(*(c for q in indexed.values() for c in q)))
    text = whole(F.col("text"))
    none = F.array().cast(SPANS)
    scanned = [rule_spans(text, n, rule) for n, rule in enumerate(rules) if n not in indexed]
    row = F.struct(*(carried or docs.columns)).alias("row")
    if not indexed:
        return docs.select(row, F.array_sort(F.concat(none, *scanned)).alias("spans"))
    index = kept(postings(docs, grams))
    # Two numbers for each candidate: where they are few enough to be broadcast, no text moves at all.
    found = small_side(kept(candidates(index, indexed)))
    # A text without the rarest trigram of any clause can't be a candidate: it needn't move.
    frequency = dict(index.groupBy("gram").count().collect())  # a row for each of the rules' trigrams
    anchors = {min(sorted(c), key=lambda g: frequency.get(g, 0)) for q in indexed.values() for c in q}
    lower = F.lower(text)
    may_match = reduce(lambda a, b: a | b, (F.contains(lower, F.lit(g)) for g in sorted(anchors)))
    dealt = docs.select(
        row,
        text_key().alias("key"),
        F.when(may_match, text).alias("moved"),
        F.concat(none, *scanned).alias("scanned"),
    )
    joined = dealt.join(found, "key", "left")
    verified = [
        F.when(
            F.col("rules").bitwiseAND(1 << n) != 0, rule_spans(F.col("moved"), n, rules[n])
        ).otherwise(none)
        for n in indexed
    ]
    return joined.select("row", F.array_sort(F.concat(F.col("scanned"), *verified)).alias("spans"))


def _in_runs(items: Column) -> Column:
    """Slices of RUN items."""
    return F.transform(
        F.sequence(F.lit(0), F.size(items) - 1, F.lit(RUN)), lambda s: F.slice(items, s + 1, RUN)
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with every stretch under spans replaced by one mark.

    Spans are worked off in runs, each on its own stretch of the text, so that neither the text nor what
    was said so far is copied for every span.
    """
    runs = _in_runs(spans)
    lasts = F.transform(runs, lambda run: F.array_max(F.transform(run, lambda s: s["end"])))
    edges = F.aggregate(
        lasts,
        F.array(F.lit(0)),
        lambda so_far, last: F.concat(so_far, F.array(F.greatest(F.element_at(so_far, -1), last))),
    )
    count = F.size(lasts)
    placed = F.zip_with(runs, F.slice(edges, 1, count), lambda run, a: F.struct(run.alias("run"), a.alias("begin")))
    placed = F.zip_with(
        placed,
        F.slice(edges, 2, count),
        lambda p, b: F.struct(
            p["run"].alias("run"),
            p["begin"].alias("begin"),
            F.substring(text, p["begin"] + 1, b - p["begin"]).alias("stretch"),
        ),
    )

    def said(p: Column) -> Column:
        def step(so_far: Column, span: Column) -> Column:
            gap = F.substring(p["stretch"], so_far["at"] - p["begin"] + 1, span["start"] - so_far["at"])
            return F.struct(
                F.greatest(so_far["at"], span["end"]).alias("at"),
                F.when(span["start"] >= so_far["at"], F.concat(so_far["said"], gap, F.lit(MARK)))
                .otherwise(so_far["said"])
                .alias("said"),
            )

        start = F.struct(p["begin"].alias("at"), F.lit("").alias("said"))
        return F.aggregate(p["run"], start, step, lambda s: s["said"])

    rest = F.substring(text, F.element_at(edges, -1) + 1, F.char_length(text))
    return F.when(F.size(spans) > 0, F.concat(F.array_join(F.transform(placed, said), ""), rest)).otherwise(text)


def without_secrets(docs: DataFrame) -> DataFrame:
    """The documents with secrets replaced by MARK and ``n_chars`` counted anew; all columns stay."""
    text = F.col("row.text")
    clean = redacted(text, F.col("spans"))
    return find_secrets(docs).select(
        *(
            clean.alias(c)
            if c == "text"
            else F.when(F.size("spans") > 0, F.char_length(clean).cast(docs.schema[c].dataType)).otherwise(F.col(f"row.{c}")).alias(c)
            if c == "n_chars"
            else F.col("row").getField(c).alias(c)
            for c in docs.columns
        )
    )


def _shown(spans: Column, rules: tuple[Rule, ...]) -> Column:
    kinds = F.array(*(F.lit(rule.kind) for rule in rules))
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def secrets_digest(docs: DataFrame) -> DataFrame:
    found = find_secrets(docs, carried=["doc_id"])
    spans = F.col("spans")

    def count(kind: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        *(count(n).alias(f"n_{RULES[n].kind}") for n in range(BASE)),
        F.sha2(_shown(F.filter(spans, lambda s: s["kind"] < BASE), RULES), 256).alias("base_sha256"),
        _shown(spans, RULES).alias("spans"),
    )


def _sql() -> str:
    """Matches and the gaps between them, by rule; a span's start is the length of all before it."""
    parts = []
    for n, rule in enumerate(RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(f"""
        select rid, {n} as kind, unnest(list_filter(list_transform(range(1, len(matches) + 1), lambda i: {{
            'start': coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0)
                     + coalesce(list_sum(list_transform(matches[1:i - 1], lambda x: length(x))), 0),
            'chars': length(matches[i]), 'counted': length(counted[i])}}), lambda s: s.counted >= {rule.least})) as s
        from (select rid, regexp_extract_all(text, '{pattern}') as matches,
                     regexp_extract_all(text, '{pattern}', {rule.group}) as counted,
                     regexp_split_to_array(text, '{pattern}') as gaps
              from docs)""")
    names = ", ".join(f"'{rule.kind}'" for rule in RULES)
    return f"""
    with docs as (select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents),
    found as ({" union all ".join(parts)}),
    spans as (
        select rid, kind, cast(s.start as bigint) as start,
               [{names}][kind + 1] || ':' || cast(cast(s.start as bigint) as varchar) || ':'
               || cast(cast(s.start + s.chars as bigint) as varchar) as shown
        from found
    )
    select doc_id,
           {", ".join(f"count(*) filter (where kind = {n}) as n_{RULES[n].kind}" for n in range(BASE))},
           sha256(coalesce(string_agg(shown, ',' order by start, kind) filter (where kind < {BASE}), '')) as base_sha256,
           coalesce(string_agg(shown, ',' order by start, kind), '') as spans
    from docs left join spans using (rid) group by rid, doc_id
    """


SECRETS_SQL = _sql()
