"""Personal data by fixed patterns and bootstrapped contextual extraction, in DataFrame functions only.

The fixed patterns find e-mail addresses, IP addresses, card and phone numbers. The bootstrap adds identifiers that they miss:
keys, tokens, passwords, accounts. A text is read as runs, which end at white space, quotes, brackets and the marks =:;,|. A
candidate is a strong run (eight characters or more between its outer marks, a digit or an at sign among them) or any run
behind a label, a word with = or : after it. Seed entities are the runs that hold a base span and random strings, of
RANDOM_LENGTH letters and digits or more that change between these at least SWITCHES times.

Each candidate induces lexical patterns: its label ('password='), its outline ('9.9.9.9'), its form (kinds of characters and
length: 'hex|40') and its head (first four letters and form: 'AKIA|A9|20'). All see the whole run; long outlines count by
their hash. Weak runs have their label alone and are values of that label only, so that a word that once was a password stays
a word elsewhere; where they begin a base span, as '+1' does, the value is what that holds. Words without a mark behind them are no labels: what else follows them would have to be counted to judge them.

Rounds score the graph of patterns and values, in which a value of a pattern is one edge however often it occurs and equal texts count
once. A pattern's confidence is pos / (pos + UNKNOWN * rest + SMOOTH), pos being the belief in its values, where pos is
SUPPORT at least: values that no seed covers are unknown rather than benign, and UNKNOWN holds down what seeds by chance give,
as the tenth of all numbers that pass Luhn. A value that is no seed is believed as far as the noisy-or of its patterns of
CONFIDENT or more says. Values so believed to ACCEPT or more are identifiers, random strings among them, and their
occurrences outside of the base spans are added as spans of kind 'ctx'.

Patterns run with possessive loops and look-behind where that cannot change the matches, and offsets are summed in blocks, so
that the time hardly grows faster than the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewright.llm.common import SPACE, table, text_of, written

ROUNDS, SUPPORT, SMOOTH, UNKNOWN, CONFIDENT, ACCEPT = 3, 3, 0.5, 0.2, 0.8, 0.85
#: Characters of a strong run at least; letters and digits of a random string at least, and its changes between them.
STRONG_LENGTH, RANDOM_LENGTH, SWITCHES = 8, 16, 4
#: Characters of an outline or label that is not replaced by its hash.
PLAIN = 64

KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a kind's pattern to be worth running.
GATES = {
    "email": "contains({t}, '@')",
    "ip": r"{t} rlike r'[0-9]\.[0-9]++\.[0-9]++\.[0-9]'",
    "card": r"{t} rlike r'[0-9](?:[\x20-]?[0-9]){{11}}'",
    "phone": "contains({t}, '+')",
}
#: Characters between runs, as a regular-expression class body, and the label's marks, after which blanks and quotes may follow.
BETWEEN = SPACE + r"\x22\x27\x60=:;,|<>(){}\[\]"
_LABELLED = r"(?<=[=:]|[=:][\x20\x22\x27\x60]|[=:][\x20\x22\x27\x60]{2})"
CANDIDATE = rf"(?<![^{BETWEEN}])(?:[^{BETWEEN}0-9@]*+[0-9@][^{BETWEEN}]*+|{_LABELLED}[^{BETWEEN}]++)"
#: Start, kind, end and, for base spans, a hash of what they hold.
SPANS = "array<struct<a:int,k:int,b:int,h:bigint>>"


def _digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


def _valid(kind: str) -> str:
    """SQL condition on the match m."""
    if kind == "ip":
        return "forall(split(m, '[.]'), p -> length(ltrim('0', p)) <= 3 AND coalesce(try_cast(ltrim('0', p) AS int), 0) <= 255)"
    if kind == "phone":
        return f"length({_digits('m')}) BETWEEN 9 AND 15"
    if kind == "card":
        d = _digits("m")
        luhn = f"aggregate(sequence(1, length({d})), 0, (s, i) -> s + cast(CASE WHEN i % 2 = 1 THEN cast(substring(reverse({d}), i, 1) AS int) ELSE (2 * cast(substring(reverse({d}), i, 1) AS int)) div 10 + (2 * cast(substring(reverse({d}), i, 1) AS int)) % 10 END AS int)) % 10 = 0"
        return f"(CASE WHEN length({d}) BETWEEN 12 AND 19 THEN {luhn} ELSE false END)"
    return "true"


def _counter() -> Column:
    """Whether the run core has the form of a card, IP address or phone number and fails the rule of that kind."""
    forms = {"card": r"^[0-9](?:-?[0-9])++$", "ip": r"^[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++$", "phone": r"^\+[0-9][().0-9-]++$"}
    long = {"card": f"length({_digits('core')}) >= 12 AND "}
    held = {k: f"core rlike {_literal(form)} AND {long.get(k, '')} NOT transform(array(core), m -> {_valid(k)})[0]" for k, form in forms.items()}
    return F.expr(" OR ".join(f"({x})" for x in held.values()))


def _literal(pattern: str) -> str:
    return "r'" + pattern + "'"


def _ends(steps: str) -> str:
    """SQL for the running sums of an array of ints: within blocks of the cube root of its size and over the blocks, since a
    list that grows by one is copied each time."""
    none = "cast(array() AS array<int>)"
    sums = "aggregate({x}, named_struct('at', {at}, 'out', " + none + "), (s, v) -> named_struct('at', s.at + v, 'out', array_append(s.out, {kept})), s -> s.out)"
    starts = sums.format(x="transform(blocks, b -> aggregate(b, 0, (s, v) -> s + v))", at="0", kept="s.at")
    inside = sums.format(x="b", at="p", kept="s.at + v")
    by_block = f"transform(array(transform(sequence(0, size(x) - 1, cast(ceil(cbrt(size(x))) AS int)), i -> slice(x, i + 1, cast(ceil(cbrt(size(x))) AS int)))), blocks -> flatten(zip_with({starts}, blocks, (p, b) -> {inside})))[0]"
    return f"transform(array({steps}), x -> CASE WHEN size(x) > 0 THEN {by_block} ELSE {none} END)[0]"


def _matches(pattern: str, text: str) -> str:
    """SQL for the matches of a pattern as array<struct<m, piece, b>>: piece is the text since the match before, b the end."""
    p = _literal(pattern)
    pairs = f"zip_with(regexp_extract_all({text}, {p}, 0), split({text}, {p}, -1), (m, piece) -> named_struct('m', m, 'piece', piece))"
    placed = f"zip_with(z, {_ends('transform(z, y -> length(y.piece) + length(y.m))')}, (y, b) -> named_struct('m', y.m, 'piece', y.piece, 'b', b))"
    return f"transform(array(filter({pairs}, y -> y.m IS NOT NULL)), z -> {placed})[0]"


def base_spans(kind: str, text: str = "text") -> str:
    """SQL for the spans of a kind in a text."""
    k, none = KINDS.index(kind), f"cast(array() AS {SPANS})"
    held = f"filter({_matches(PATTERNS[kind], text)}, y -> transform(array(y.m), m -> {_valid(kind)})[0])"
    return f"CASE WHEN {GATES[kind].format(t=text)} THEN cast(transform({held}, y -> named_struct('a', y.b - length(y.m), 'k', {k}, 'b', y.b, 'h', xxhash64(y.m))) AS {SPANS}) ELSE {none} END"


def candidates(text: str = "text") -> str:
    """SQL for the candidate runs of a text, in order, as (run, b, tail): the run, its end and, where a mark of a label is in
    it, what stands between it and the run before, else ''. The run before is the piece's last or, in a piece without one,
    the candidate before."""
    kind = "array<struct<run:string,b:int,word:string,tail:string>>"
    # Reversed, so that the expressions start where the text between ends.
    tail = rf"reverse(regexp_extract(reverse(y.piece), r'^[{BETWEEN}]*+', 0))"
    word = rf"reverse(regexp_extract(reverse(y.piece), r'^[{BETWEEN}]*+([^{BETWEEN}]*+)', 1))"
    before = f"transform({_matches(CANDIDATE, text)}, y -> named_struct('run', y.m, 'b', y.b, 'word', {word}, 'tail', {tail}))"
    whole = "transform(array(" + before + "), q -> transform(q, (y, i) -> named_struct('run', y.run, 'b', y.b, 'word', CASE WHEN y.word = '' AND i > 0 THEN q[i - 1].run ELSE y.word END, 'tail', CASE WHEN y.tail rlike '[=:]' THEN y.tail ELSE '' END)))[0]"
    return f"CASE WHEN {text} rlike '[0-9@=:]' THEN cast({whole} AS {kind}) ELSE cast(array() AS {kind}) END"


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, proof (of the text), base (all kinds' spans, sorted) and cands of every document."""
    rows = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("text"))
    spans = ", ".join(base_spans(k) for k in KINDS)
    return rows.select("doc_id", F.md5(F.col("text").cast("binary")).alias("proof"), F.expr(f"array_sort(concat({spans}))").alias("base"), F.expr(candidates()).alias("cands"))


def _bounded(x: Column) -> Column:
    return F.when(F.length(x) <= PLAIN, x).otherwise(F.md5(x.cast("binary")))


def occurrences(rows: DataFrame) -> DataFrame:
    """proof, a, b, value, seed, wrong (a counter-example), loose (outside of all base spans) and patterns of each candidate of each distinct text."""
    texts = rows.where(F.size("cands") > 0).groupBy("proof").agg(F.first("base").alias("base"), F.first("cands").alias("cands"))
    texts = written(texts, "pii-texts")
    one = texts.select("proof", F.explode("cands").alias("c")).select("proof", "c.*")
    begun = F.regexp_replace("run", r"^[^\p{L}\p{N}]++", "")
    one = one.select("proof", "run", "b", "word", "tail", begun.alias("begun"))
    one = one.withColumn("core", F.regexp_replace("begun", r"(?<=[\p{L}\p{N}])[^\p{L}\p{N}]++$", ""))
    one = one.withColumn("a", F.col("b") - F.length("begun")).withColumn("b", F.col("a") + F.length("core")).where("core <> ''")
    # Base spans take their places among the candidates: of those that start before a candidate's end the one that ends last
    # overlaps it if any does; of those that do not start before it the one that ends first lies in it if any does.
    spans = texts.select("proof", F.explode("base").alias("s")).select("proof", F.col("s.a").alias("a"), F.col("s.b").alias("b"), "s")
    both = one.unionByName(spans, allowMissingColumns=True)
    upto = Window.partitionBy("proof").orderBy(F.when(F.col("s").isNull(), F.col("b") - 1).otherwise(F.col("a")), F.col("s").isNull())
    onward = Window.partitionBy("proof").orderBy(F.col("a").desc(), F.col("s").isNull())
    most = F.max(F.struct("s.b", "s.k", "s.h")).over(upto.rowsBetween(Window.unboundedPreceding, 0))
    least = F.min("s.b").over(onward.rowsBetween(Window.unboundedPreceding, 0))
    one = both.withColumns({"most": F.when(most.b.isNotNull(), most), "least": least}).where("s IS NULL").drop("s")
    one = one.withColumn("loose", ~F.coalesce(F.col("most.b") > F.col("a"), F.lit(False))).withColumn("whole", F.coalesce(F.col("least") <= F.col("b"), F.lit(False)))
    switches = F.size(F.regexp_extract_all("core", F.lit(r"[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])"), F.lit(0)))
    random = F.col("core").rlike(rf"^[A-Za-z0-9+/_-]{{{RANDOM_LENGTH},}}+$") & (switches >= SWITCHES)
    one = one.withColumn("strong", (F.col("loose") | F.col("whole")) & (F.length("core") >= STRONG_LENGTH) & F.col("core").rlike("[0-9@]"))
    one = one.withColumn("label", F.when(F.col("tail") != "", _bounded(F.concat(F.lower("word"), F.regexp_replace("tail", f"[{SPACE}]+", " ")))))
    marks = F.array_join(F.array_sort(F.array_distinct(F.split(F.regexp_replace("core", r"[\p{L}\p{N}]+", ""), ""))), "")
    has = lambda cls, name: F.when(F.col("core").rlike(cls), name).otherwise("")
    kinds = F.when(F.col("core").rlike("^[0-9a-f]++$") & F.col("core").rlike("[a-f]"), "hex").otherwise(F.concat(has(r"\p{Ll}", "a"), has(r"\p{Lu}", "A"), has("[0-9]", "9"), marks))
    one = one.withColumn("form", F.concat(kinds, F.lit("|"), F.length("core")))
    outline = F.regexp_replace(F.regexp_replace("core", r"\p{L}+", "a"), "[0-9]+", "9")
    patterns = F.array(
        F.concat(F.lit("label:"), F.col("label")),
        F.when(F.col("strong") & F.col("core").rlike(r"[^\p{L}\p{N}]"), F.concat(F.lit("outline:"), _bounded(outline))),
        F.when(F.col("strong"), F.concat(F.lit("form:"), F.col("form"))),
        F.when(F.col("strong") & F.col("core").rlike("^[A-Za-z]{4}"), F.concat(F.lit("head:"), F.left("core", F.lit(4)), F.lit("|"), F.col("form"))),
    )
    entity = F.when(~F.col("loose"), F.col("most.h").cast("string"))
    value = F.md5(F.when(F.col("strong"), F.col("core")).otherwise(F.concat_ws(" ", "label", F.coalesce(entity, "core"))).cast("binary"))
    wrong = F.col("loose") & _counter()
    out = one.select("proof", "a", "b", value.alias("value"), (~F.col("loose") | (random & ~wrong)).alias("seed"), wrong.alias("wrong"), "loose", F.array_compact(patterns).alias("patterns"))
    return out.where(F.size("patterns") > 0)


def believed(occ: DataFrame) -> DataFrame:
    """value and belief of the values that confident patterns hold for identifiers, after the rounds.

    The edges are one row for each pattern and value, and sums by pattern are taken in part before they are dealt, so a common
    pattern has no hot task.
    """
    edges = written(occ.select("value", "seed", "wrong", F.explode("patterns").alias("pattern")).groupBy("pattern", "value").agg(F.max("seed").alias("seed"), F.max("wrong").alias("wrong")), "pii-edges")
    belief = None
    for _ in range(ROUNDS):
        known = edges.withColumn("s", F.col("seed").cast("double"))
        if belief is not None:
            known = edges.join(belief, "value", "left").withColumn("s", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("belief", F.lit(0.0))))
        sums = known.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), F.sum("s").alias("s"), F.count_if(F.col("wrong") & ~F.col("seed")).alias("neg")).where(f"s >= {SUPPORT}")
        rest = F.col("n") - F.col("s") - F.col("neg")
        conf = sums.select("pattern", (F.col("s") / (F.col("s") + F.col("neg") + UNKNOWN * rest + SMOOTH)).alias("conf")).where(f"conf >= {CONFIDENT}")
        held = edges.where("seed OR NOT wrong").join(written(conf, "pii-patterns"), "pattern")
        belief = written(held.groupBy("value").agg((1 - F.exp(F.sum(F.log(1 - F.least("conf", F.lit(1 - 1e-9)))))).alias("belief")), "pii-belief")
    return belief.where(f"belief >= {ACCEPT}")


def _listed(spans: str, names: str) -> Column:
    return F.expr(f"array_join(transform({spans}, s -> concat(element_at({names}, s.k + 1), ':', s.a, ':', s.b)), ',')")


def extracted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_ctx and n_spans.

    Null texts count as empty; texts without a match have the hash of no spans. Repeated rows get equal results; no rows give
    no rows; further columns are ignored. A run of any length takes part whole.
    """
    rows = written(found(docs, id_col, text_col), "pii-found")
    occ = written(occurrences(rows), "pii-occurrences")
    extra = occ.where("loose AND NOT wrong").join(believed(occ), "value").groupBy("proof").agg(F.collect_list(F.struct("a", F.lit(len(KINDS)).alias("k"), "b", F.lit(0).alias("h"))).cast(SPANS).alias("extra"))
    names = "array(" + ", ".join(f"'{k}'" for k in (*KINDS, "ctx")) + ")"
    none = F.expr(f"cast(array() AS {SPANS})")
    # Rows without a candidate have nothing to join; a text that many rows repeat is one row of extra.
    plain = rows.where(F.size("cands") == 0).select("doc_id", "base", none.alias("extra"))
    joined = rows.where(F.size("cands") > 0).select("doc_id", "proof", "base").join(extra, "proof", "left").select("doc_id", "base", F.coalesce("extra", none).alias("extra"))
    both = plain.union(joined).withColumn("spans", F.array_sort(F.concat("base", "extra")))
    return both.select(
        "doc_id",
        *[F.expr(f"size(filter(base, s -> s.k = {i}))").cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(_listed("base", names), 256).alias("base_sha256"),
        _listed("spans", names).alias("spans"),
        F.size("extra").cast("long").alias("n_ctx"),
        F.size("spans").cast("long").alias("n_spans"),
    )


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "documents"))
