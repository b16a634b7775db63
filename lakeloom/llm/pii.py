r"""Personal data by weak supervision, in DataFrame expressions alone.

Base spans are the matches of four fixed patterns with their checks (address
parts up to 255, card numbers of 13 to 19 digits that pass Luhn, phone numbers
of 9 to 15 digits).  The method adds spans among wider candidates: written-out
e-mail addresses, and every stretch of neighbouring digit groups, 9 to 19 digits
in all, that touches no base span; so numbers side by side are told apart.

1. Labelers vote on every candidate and base span (1 for, -1 against, 0 no
   opinion): the base pattern's own check, the Luhn or range checksum, a
   gazetteer (card issuers' prefixes, top-level domains), words before the span
   in four languages, and the usual grouping of digits.
2. Spans are counted by kind, votes and features: a table whose size is bounded
   by the number of combinations, whatever the corpus.  Expectation-maximisation
   runs on that table: posteriors from the labelers' reliabilities and the
   kinds' shares, then both anew from the posteriors, one small aggregate a
   round.
3. The final classifier, naive Bayes over a span's features (kind, number of
   digits, grouping, neighbours, context), is trained on the posteriors; it is a
   handful of weights that become literals in the second pass.
4. The second pass adds the candidates whose log odds reach ``ADD`` and that
   overlap no base span, of overlapping ones the best by log odds, then the
   longer.  A candidate that fails its checksum is never added.

Positions come from splitting the text at the matches: the lengths of the gaps
and matches before a match add up to its place, in code points.  The patterns
are the plain ones made linear: possessive where nothing can be given back, and
not tried inside a run whose start has already failed.

Both passes are narrow; only the counts by combination are shuffled.

Defined cases: NULL text is empty (no spans); whole texts of any length;
repeated rows give repeated results; empty tables give empty results; with no
candidate at all nothing is added; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.store import written

KINDS = ("email", "ip", "card", "phone")
# The base patterns, as linear equivalents of
#   [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+     [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   [0-9]([\x20-]?[0-9])+                                 \+[0-9][\x20().0-9-]+[0-9]
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Candidates of the method (kind is set by their form).
WRITTEN_EMAIL = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:\(at\)|\[at\])\x20?"
                 r"[A-Za-z0-9-]{1,63}+(?:\x20?(?:\(dot\)|\[dot\]|\.)\x20?[A-Za-z0-9-]{1,63}+){1,4}")
DIGIT_GROUP = r"(?<![A-Za-z0-9])[0-9]++(?![A-Za-z])"
#: What may stand between two groups of one number, and the digits of a number.
BETWEEN, LEAST, MOST = r"^[\x20().-]{1,2}$", 9, 19
# Gazetteers and context words.
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|35|36|38|6011|65|62)"
DOMAINS = r"(?i)\.(?:com|org|net|edu|gov|info|io|de|fr|es|eu|uk|ch|at|it|nl|us|ca|co|biz)$"
CONTEXT = {
    "email": r"(?i)(?:e-?mail|mail|correo|courriel|contact|kontakt|write to)\W{0,12}$",
    "ip": r"(?i)(?:\bip|host|server|address|adresse|servidor|serveur|login|client)\W{0,12}$",
    "card": r"(?i)(?:card|visa|mastercard|amex|credit|karte|kreditkarte|carte|tarjeta|cuenta)\W{0,12}(?:no|nr|number|nummer|num|número|numéro)?\W{0,6}$",
    "phone": r"(?i)(?:phone|tel|telefon|tél|téléphone|teléfono|call|mobile|handy|fax|cell)\W{0,12}$",
}
AGAINST = r"(?i)(?:version|order|invoice|isbn|issn|token|sha|id|no\.|page|=|#|\$)\W{0,6}$"
LABELERS = ("rule", "checksum", "gazetteer", "context", "shape")
#: First reliability of each labeler, rounds of EM, and the log odds a candidate must reach.
FIRST = {"rule": 0.8, "checksum": 0.9, "gazetteer": 0.65, "context": 0.85, "shape": 0.65}
ROUNDS, ADD = 8, 2.0
#: Characters of context on either side of a span.
NEAR = 40


def _running(lengths: str) -> str:
    """SQL for the running sums of an integer array, in blocks of 256."""
    return (f"transform(sequence(0, size({lengths}) - 1), i -> "
            f"aggregate(slice(sums, 1, int(i / 256)), 0, (a, x) -> a + x) + "
            f"aggregate(slice({lengths}, int(i / 256) * 256 + 1, i % 256 + 1), 0, (a, x) -> a + x))")


def _sql(pattern: str) -> str:
    return "r'" + pattern.replace("'", "\\'") + "'"


def found_spans(df: DataFrame, name: str, pattern: str, guard: str, lead: int = 0) -> DataFrame:
    """``df`` (with ``text``) and ``name``: array of ``from, upto, value`` of the
    pattern's matches; ``guard`` is a cheap condition any match needs.  With
    ``lead`` also up to so many characters between the match before and this one."""
    m, g, z, b = f"_m_{name}", f"_g_{name}", f"_z_{name}", f"_b_{name}"
    nothing = "CAST(array() AS array<string>)"
    df = (df.withColumn(m, F.expr(f"CASE WHEN {guard} THEN regexp_extract_all(text, {_sql(pattern)}, 0) ELSE {nothing} END"))
          .withColumn(g, F.expr(f"CASE WHEN size({m}) > 0 THEN split(text, {_sql(pattern)}, -1) ELSE {nothing} END"))
          .withColumn(b, F.expr(f"transform({m}, (x, i) -> right({g}[i], {lead}))"))
          .withColumn(z, F.expr(f"transform({m}, (x, i) -> length(x) + length({g}[i]))"))
          .withColumn("sums", F.expr(f"transform(sequence(0, int(size({z}) / 256)), b -> "
                                     f"aggregate(slice({z}, b * 256 + 1, 256), 0, (a, x) -> a + x))"))
          .withColumn(g, F.expr(f"CASE WHEN size({z}) > 0 THEN {_running(z)} ELSE CAST(array() AS array<int>) END"))
          .withColumn(name, F.expr(f"transform({m}, (x, i) -> struct({g}[i] - length(x) AS from, {g}[i] AS upto, x AS value"
                                    f"{f', {b}[i] AS lead' if lead else ''}))")))
    return df.drop(m, g, z, b, "sums")


def stretches(groups: str) -> str:
    """SQL: ``from, upto, value`` of every stretch of neighbouring ``groups``
    (``from, upto, value, lead, free``) of ``LEAST`` to ``MOST`` digits, a plus or
    bracket before it included.  A stretch has at most ``MOST`` groups, so this is
    linear in the groups."""
    opened = "(g.lead RLIKE '[^A-Za-z0-9.+][+(]$' OR i = 0 AND g.lead RLIKE '^[+(]$')"
    joined = f"x.lead RLIKE {_sql(BETWEEN)}"
    digits = "a.n + length(x.value)"
    value = f"concat(CASE WHEN x.from > g.from THEN concat(a.value, x.lead) WHEN {opened} THEN right(g.lead, 1) ELSE '' END, x.value)"
    span = f"struct(g.from - int({opened}) AS from, x.upto AS upto, {value} AS value)"
    none = "CAST(array() AS array<struct<from: int, upto: int, value: string>>)"
    return (f"flatten(transform({groups}, (g, i) -> CASE "
            f"WHEN g.lead RLIKE '[.+]$' AND NOT {opened} AND NOT (i > 0 AND g.lead RLIKE {_sql(BETWEEN)}) THEN {none} "
            f"ELSE aggregate(slice({groups}, i + 1, {MOST}), struct(0 AS n, '' AS value, {none} AS found), "
            f"(a, x) -> CASE WHEN a.n >= 0 AND x.free AND (x.from = g.from OR {joined}) AND {digits} <= {MOST} "
            f"THEN struct({digits} AS n, {value} AS value, CASE WHEN {digits} >= {LEAST} "
            f"THEN concat(a.found, array({span})) ELSE a.found END AS found) "
            f"ELSE struct(-1 AS n, '' AS value, a.found AS found) END, a -> a.found) END))")


def best_apart(spans: str) -> str:
    """SQL: the best of ``spans`` (``from, upto, kind, value, odds``) that do not
    overlap, best first, then the longer, then the earlier; spans that overlap in
    a chain are settled among themselves."""
    order = ("(l, r) -> CASE WHEN l.odds > r.odds THEN -1 WHEN l.odds < r.odds THEN 1 "
             "WHEN l.upto - l.from <> r.upto - r.from THEN r.upto - r.from - l.upto + l.from ELSE l.from - r.from END")
    none = "CAST(array() AS array<struct<from: int, upto: int, kind: string, value: string, odds: double>>)"
    settled = lambda chain: (f"aggregate(array_sort({chain}, {order}), {none}, (k, c) -> CASE WHEN "  # noqa: E731
                             "exists(k, o -> o.from < c.upto AND c.from < o.upto) THEN k ELSE concat(k, array(c)) END)")
    return (f"aggregate(array_sort({spans}), struct(0 AS upto, {none} AS chain, {none} AS done), "
            f"(a, s) -> CASE WHEN s.from < a.upto THEN struct(greatest(a.upto, s.upto) AS upto, concat(a.chain, array(s)) AS chain, a.done AS done) "
            f"ELSE struct(s.upto AS upto, array(s) AS chain, concat(a.done, {settled('a.chain')}) AS done) END, "
            f"a -> concat(a.done, {settled('a.chain')}))")


def _digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


def luhn(x: str) -> str:
    """SQL: does the digit string of 1 to 19 digits pass the Luhn check?"""
    at = f"int(substr({x}, length({x}) - i + 1, 1))"
    return (f"(aggregate(sequence(1, length({x})), 0, (a, i) -> a + CASE WHEN i % 2 = 1 THEN {at} "
            f"WHEN {at} > 4 THEN 2 * {at} - 9 ELSE 2 * {at} END) % 10 = 0)")


def _octets(x: str) -> str:
    return (f"forall(split({x}, '[.]'), p -> length(trim(LEADING '0' FROM p)) <= 3 AND "
            f"int('0' || trim(LEADING '0' FROM p)) <= 255)")


def _valid(kind: str, x: str) -> str:
    d = _digits(x)
    return {"email": "true", "ip": _octets(x),
            "card": f"CASE WHEN length({d}) BETWEEN 13 AND 19 THEN {luhn(d)} ELSE false END",
            "phone": f"length({d}) BETWEEN 9 AND 15"}[kind]


def _with_spans(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """``id, text``, the base spans per kind and the method's candidates, none
    of them overlapping a base span."""
    df = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *more)
    df = df.withColumn("_digit", F.expr("text RLIKE '[0-9]{3}|[0-9][^0-9][0-9]'"))
    guards = {"email": "contains(text, '@')", "ip": "_digit", "card": "_digit", "phone": "contains(text, '+')"}
    for kind in KINDS:
        df = found_spans(df, kind, PATTERNS[kind], guards[kind])
        df = df.withColumn(kind, F.expr(f"filter({kind}, s -> {_valid(kind, 's.value')})"))
    df = found_spans(df, "_written", WRITTEN_EMAIL, "contains(text, 'at)') OR contains(text, 'at]')")
    df = found_spans(df, "_groups", DIGIT_GROUP, r"text RLIKE '[0-9][\x20().-]{0,2}[0-9]'", lead=3)
    df = df.withColumn("base", F.expr("concat(" + ", ".join(
        f"transform({k}, s -> struct('{k}' AS kind, s.from, s.upto, s.value, true AS base))" for k in KINDS) + ")"))
    # no base span lies between two groups: what overlaps one holds a group of it
    df = df.withColumn("_groups", F.expr("transform(_groups, g -> struct(g.from, g.upto, g.value, g.lead, "
                                         "NOT exists(base, b -> b.from < g.upto AND g.from < b.upto) AS free))"))
    df = df.withColumn("_groups", F.expr(stretches("_groups")))
    n = f"length({_digits('s.value')})"
    kind = f"CASE WHEN {n} >= 13 AND NOT (s.value LIKE '+%' AND {n} <= 15) THEN 'card' ELSE 'phone' END"
    df = df.withColumn("others", F.expr(
        "filter(concat(transform(_written, s -> struct('email' AS kind, s.from, s.upto, s.value, false AS base)), "
        f"transform(_groups, s -> struct({kind} AS kind, s.from, s.upto, s.value, false AS base))), "
        "c -> NOT exists(base, b -> b.from < c.upto AND c.from < b.upto))"))
    return df.select("id", "text", "base", "others", *more)


def _votes(span: str) -> dict[str, str]:
    """SQL of each labeler's vote on a span struct with ``before`` and ``after``."""
    s, d = span, _digits(f"{span}.value")
    by_kind = lambda cases: "CASE " + " ".join(f"WHEN {s}.kind = '{k}' THEN {v}" for k, v in cases.items()) + " ELSE 0 END"
    vote = lambda c: f"CASE WHEN {c} THEN 1 ELSE -1 END"
    return {
        "rule": f"CASE WHEN {s}.base THEN 1 ELSE -1 END",
        "checksum": by_kind({"card": vote(_valid("card", f"{s}.value")),
                             "ip": vote(f"NOT {s}.value RLIKE '^(0|255)[.]'"),
                             "phone": vote(f"{d} NOT RLIKE '^(.)\\\\1+$' AND length({d}) >= 10")}),
        "gazetteer": by_kind({"card": vote(f"{d} RLIKE '{ISSUERS}'"),
                              "email": f"CASE WHEN {s}.value RLIKE {_sql(DOMAINS)} THEN 1 ELSE 0 END"}),
        "context": f"CASE WHEN {by_kind({k: f'CASE WHEN {s}.before RLIKE {_sql(p)} THEN 1 ELSE 0 END' for k, p in CONTEXT.items()})} = 1 "
                   f"THEN 1 WHEN {s}.before RLIKE {_sql(AGAINST)} THEN -1 ELSE 0 END",
        "shape": by_kind({
            "card": vote(f"{s}.value RLIKE '^[0-9]{{4}}([ -]?[0-9]{{4}}){{3}}$|^[0-9]{{4}}[ -]?[0-9]{{6}}[ -]?[0-9]{{5}}$'"),
            "phone": vote(f"{s}.value RLIKE '[0-9]{{3}}[) .-]+[0-9]{{3}}[ .-][0-9]{{4}}$'"),
            "ip": vote(f"NOT {s}.value RLIKE '(^|[.])0[0-9]'")}),
    }


def _features(span: str) -> dict[str, str]:
    s, d = span, _digits(f"{span}.value")
    return {"digits": f"least(20, length({d}))", "grouped": f"int({s}.value RLIKE '[0-9][^0-9]+[0-9]')",
            "plus": f"int({s}.value LIKE '+%')", "bracket": f"int(contains({s}.value, '('))",
            "alone": f"int({s}.before RLIKE '(^|\\\\s)$' AND {s}.after RLIKE '^(\\\\s|[.,;:!?]|$)')",
            "context": _votes(s)["context"], "checksum": _votes(s)["checksum"], "shape": _votes(s)["shape"]}


def _around(spans: str) -> str:
    return (f"transform({spans}, s -> struct(s.kind, s.from, s.upto, s.value, s.base, "
            f"substr(text, greatest(1, s.from - {NEAR - 1}), least({NEAR}, s.from)) AS before, "
            f"substr(text, s.upto + 1, 4) AS after))")


def counted(spans: DataFrame) -> DataFrame:
    """Spans by kind, votes and features: a table of bounded size."""
    one = spans.select(F.explode(F.expr(_around("concat(base, others)"))).alias("s"))
    cols = ([F.col("s.kind")] + [F.expr(v).cast("int").alias(f"v_{k}") for k, v in _votes("s").items()]
            + [F.expr(v).cast("int").alias(f"f_{k}") for k, v in _features("s").items()])
    one = one.select(*cols)
    return one.groupBy(*one.columns).agg(F.count(F.lit(1)).alias("n"))


def _posterior(reliable: dict[str, float], share: dict[str, float]) -> Column:
    prior = "CASE " + " ".join(f"WHEN kind = '{k}' THEN ln({p!r}D / (1 - {p!r}D))" for k, p in share.items()) + " ELSE 0D END"
    odds = " + ".join(f"v_{k} * ln({a!r}D / (1 - {a!r}D))" for k, a in reliable.items())
    return F.expr(f"1 / (1 + exp(-({prior} + {odds})))")


def reliabilities(table: DataFrame, rounds: int = ROUNDS) -> tuple[dict[str, float], dict[str, float]]:
    """EM on the counts: each labeler's reliability and each kind's share."""
    reliable, share = dict(FIRST), {k: 0.5 for k in KINDS}
    for _ in range(rounds):
        post = table.withColumn("p", _posterior(reliable, share))
        aggs = []
        for k in LABELERS:
            agree = F.when(F.col(f"v_{k}") == 1, F.col("p")).when(F.col(f"v_{k}") == -1, 1 - F.col("p"))
            aggs += [F.sum(F.col("n") * agree).alias(f"a_{k}"), F.sum(F.when(F.col(f"v_{k}") != 0, F.col("n"))).alias(f"t_{k}")]
        for k in KINDS:
            here = F.col("kind") == k
            aggs += [F.sum(F.when(here, F.col("n") * F.col("p"))).alias(f"s_{k}"), F.sum(F.when(here, F.col("n"))).alias(f"k_{k}")]
        row = post.agg(*aggs).first().asDict()
        # ten pseudo-votes for the first guess keep small tables and rare labelers steady
        reliable = {k: min(0.99, max(0.55, ((row[f"a_{k}"] or 0) + 10 * FIRST[k]) / ((row[f"t_{k}"] or 0) + 10))) for k in LABELERS}
        share = {k: min(0.95, max(0.05, ((row[f"s_{k}"] or 0) + 1) / ((row[f"k_{k}"] or 0) + 2))) for k in KINDS}
    return reliable, share


def classifier(table: DataFrame, posterior: Column) -> tuple[dict, dict]:
    """Naive Bayes on the posteriors: log odds per kind, and the weight of each
    (kind, feature, value)."""
    post = table.withColumn("p", posterior)
    names = [c for c in table.columns if c.startswith("f_")]
    long = post.select("kind", "n", "p", F.explode(F.array(*[
        F.struct(F.lit(c[2:]).alias("f"), F.col(c).alias("v")) for c in names], F.struct(F.lit("").alias("f"), F.lit(0).alias("v")))).alias("x"))
    rows = long.groupBy("kind", "x.f", "x.v").agg(F.sum(F.col("n") * F.col("p")).alias("yes"),
                                                  F.sum(F.col("n") * (1 - F.col("p"))).alias("no")).collect()
    total = {r.kind: (r.yes, r.no) for r in rows if r.f == ""}      # the rows are bounded by kinds x features x values
    from math import log
    bias = {k: log((y + 1) / (n + 1)) for k, (y, n) in total.items()}
    weight = {(r.kind, r.f, r.v): log((r.yes + 1) / (total[r.kind][0] + 2)) - log((r.no + 1) / (total[r.kind][1] + 2))
              for r in rows if r.f}
    return bias, weight


def _odds(span: str, bias: dict, weight: dict) -> str:
    """SQL of a span's log odds."""
    kinds = "CASE " + " ".join(f"WHEN {span}.kind = '{k}' THEN {v!r}D" for k, v in sorted(bias.items())) + " ELSE -99D END"
    terms = [kinds]
    for name, sql in _features(span).items():
        own = {(k, v): w for (k, f, v), w in weight.items() if f == name}
        if own:
            pairs = ", ".join(f"'{k}:{v}', {w!r}D" for (k, v), w in sorted(own.items()))
            terms.append(f"coalesce(try_element_at(map({pairs}), concat({span}.kind, ':', string({sql}))), 0D)")
    return " + ".join(terms)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``id, text, base, added`` (arrays of ``kind, from, upto, value``) for every
    row, and the columns named in ``keep``; text is empty where it was NULL."""
    table = written(counted(_with_spans(docs, id_col, text_col)), "pii-counts")
    bias, weight = classifier(table, _posterior(*reliabilities(table)))
    spans = _with_spans(docs, id_col, text_col, *keep)
    if not bias:                            # no candidate anywhere
        added = "others"
    else:
        passed = f"filter({_around('others')}, c -> {_votes('c')['checksum']} >= 0)"
        scored = f"transform({passed}, c -> struct(c.from, c.upto, c.kind, c.value, {_odds('c', bias, weight)} AS odds))"
        added = best_apart(f"filter({scored}, c -> c.odds >= {ADD})")
    plain = "transform({0}, s -> struct(s.kind, s.from, s.upto, s.value))"
    return (spans.withColumn("added", F.expr(f"CASE WHEN size(others) > 0 THEN {added} END"))
            .select("id", "text", F.expr(plain.format("base")).alias("base"),
                    F.expr(f"CASE WHEN added IS NULL THEN array() ELSE {plain.format('added')} END").alias("added"), *keep))


def listed(spans: str) -> str:
    """SQL: ``kind:from:upto`` of the spans, by kind, then place, comma-joined."""
    order = " ".join(f"WHEN s.kind = '{k}' THEN {i}" for i, k in enumerate(KINDS))
    keyed = f"array_sort(transform({spans}, s -> struct(CASE {order} END AS k, s.from, s.upto, s.kind)))"
    return f"array_join(transform({keyed}, s -> concat(s.kind, ':', s.from, ':', s.upto)), ',')"


def masked(found: DataFrame, out: str = "text") -> DataFrame:
    """``found`` with the spans of ``text`` replaced by their kind in capitals
    and brackets; overlapping spans are replaced as one, by the kind of the one
    that starts first (the longest of those), so nothing of any span stays."""
    none = "CAST(array() AS array<struct<from: int, upto: int, kind: string>>)"
    merged = (f"aggregate(array_sort(transform(concat(base, added), s -> struct(s.from, -s.upto AS w, s.upto, s.kind))), "
              f"struct({none} AS done, -1 AS from, -1 AS upto, '' AS kind), (a, s) -> CASE "
              "WHEN s.from < a.upto THEN struct(a.done AS done, a.from AS from, greatest(a.upto, s.upto) AS upto, a.kind AS kind) "
              "ELSE struct(IF(a.upto < 0, a.done, concat(a.done, array(struct(a.from, a.upto, a.kind)))) AS done, "
              "s.from AS from, s.upto AS upto, s.kind AS kind) END, "
              "a -> IF(a.upto < 0, a.done, concat(a.done, array(struct(a.from, a.upto, a.kind)))))")
    return (found.withColumn("_s", F.expr(merged))
            .withColumn(out, F.expr(
                "CASE WHEN size(_s) = 0 THEN text ELSE concat(array_join(transform(_s, (s, i) -> concat("
                "substr(text, if(i = 0, 0, _s[greatest(0, i - 1)].upto) + 1, s.from - if(i = 0, 0, _s[greatest(0, i - 1)].upto)), "
                "'[', upper(s.kind), ']')), ''), substr(text, _s[size(_s) - 1].upto + 1)) END"))
            .drop("_s"))


def mask_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with its columns, the spans of the text masked and the length
    column, if there is one, set to the new text's; NULL texts stay NULL."""
    whole = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.struct("*").alias("_row"))
    done = masked(find_pii(whole, "_id", "_text", ("_row",)), "_new")
    new = F.when(F.col(f"_row.`{text_col}`").isNotNull(), F.col("_new"))
    put = {text_col: new, length_col: F.length(new).cast(dict(docs.dtypes).get(length_col, "long"))}
    return done.select(*[put.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])
