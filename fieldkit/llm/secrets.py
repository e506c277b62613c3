"""Secret scans with DataFrame functions only.

Three patterns give the base spans. The method adds tokens that look random:
two first-order Markov models over characters, one of random strings, one of
ordinary identifiers, are compared by the log-likelihood ratio of a token. The
random model is trained on the distinct values found by the patterns, the
ordinary one on all tokens of all documents without such a value (that is the
label of the samples); a token counts as the square root of its occurrences, so
that thousands of copies of a text weigh little. Both are count tables over
pairs of characters, made by Spark.

Tokens are made distinct first (combined on the map side), and each distinct
one is judged once, with the model as a literal table. Only
documents that hold a flagged token are looked at again for its places.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldkit.llm.common import save

# The base patterns, in the order that ties are listed in.
ASSIGN = r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
TOKEN = r"[A-Za-z0-9+/_=-]+"
MIN_TOKEN = 8            # shortest token that the models judge
MIN_UNTAUGHT = 16        # tokens of so many characters, with a digit and a letter, do not teach the ordinary model
MIN_RATIO = 10.0         # nats by which a random string must be likelier
MIN_RATE = 0.5           # ... and nats per character
SMOOTH = 5.0             # weight of the back-off in the ordinary model, in pairs
SMOOTH_RANDOM = 200.0    # ... in the random one: neighbours in random strings hardly depend on each other

_SPANS = "array<struct<s: int, e: int>>"


def spans(text: Column, pattern: str | Column, group: int = 0, least: int = 0) -> Column:
    """[s, e) of the leftmost non-overlapping matches whose ``group`` has ``least`` characters or more.

    The text between matches and the matches alternate, so positions are running sums of lengths.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    gaps = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    part = F.regexp_extract_all(text, pattern, F.lit(group)) if group else whole
    sized = F.zip_with(whole, part, lambda w, p: F.struct(F.length(w).alias("n"), (F.length(p) >= least).alias("ok")))
    steps = F.zip_with(F.slice(gaps, 1, F.size(whole)), sized,
                       lambda g, m: F.struct(F.length(g).alias("gap"), m["n"].alias("n"), m["ok"].alias("ok")))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out"))

    def step(state: Column, m: Column) -> Column:
        s = state["at"] + m["gap"]
        e = s + m["n"]
        one = F.array(F.struct(s.alias("s"), e.alias("e")))
        return F.struct(e.alias("at"), F.when(m["ok"], F.concat(state["out"], one)).otherwise(state["out"]).alias("out"))

    return F.aggregate(steps, zero, step, lambda st: st["out"])


def _only_if(text: Column, test: str, found: Column) -> Column:
    return F.when(text.rlike(test), found).otherwise(F.array().cast(_SPANS))


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")


_ASSIGN_TEST = r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"
# a run of the class is taken whole, so the length can be asked for in the pattern
_ACCESS_TEST = r"AKIA[A-Z0-9]{%d}" % (MIN_ACCESS - 4)
_HEX_TEST, _HEX_LONG = r"[0-9a-f]{%d}" % MIN_HEX, r"[0-9a-f]{%d,}" % MIN_HEX


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty) and the spans of each pattern."""
    t = F.col("text")
    return (docs.select("doc_id", _text())
            .withColumn("assign", _only_if(t, _ASSIGN_TEST, spans(t, ASSIGN, group=2, least=MIN_ASSIGN)))
            .withColumn("access", _only_if(t, _ACCESS_TEST, spans(t, ACCESS, least=MIN_ACCESS)))
            .withColumn("hex", _only_if(t, _HEX_TEST, spans(t, _HEX_LONG))))


def _values() -> Column:
    """The secrets themselves in the base spans of a document."""
    cut = lambda name: F.transform(name, lambda s: F.substring("text", s["s"] + 1, s["e"] - s["s"]))
    value = lambda v: F.regexp_extract(v, ASSIGN, 2)
    return F.concat(F.transform(cut("assign"), value), cut("access"), cut("hex"))


def distinct_tokens(docs: DataFrame) -> DataFrame:
    """All distinct tokens of two characters or more outside what the patterns match, and how often each occurs
    in documents without a match of any pattern."""
    t, any_match = F.col("text"), F.lit(False)
    for test, pattern in ((_ASSIGN_TEST, ASSIGN), (_ACCESS_TEST, ACCESS), (_HEX_TEST, _HEX_LONG)):
        t = F.when(t.rlike(test), F.regexp_replace(t, pattern, " ")).otherwise(t)
        any_match = any_match | F.col("text").rlike(test)
    rows = docs.select(_text()).select(t.alias("text"), F.when(any_match, 0).otherwise(1).alias("n"))
    found = F.regexp_extract_all("text", F.lit(r"[A-Za-z0-9+/_=-]{2,}"), F.lit(0))
    return rows.select(F.explode(found).alias("token"), "n").groupBy("token").agg(F.sum("n").alias("n"))


def _pairs(tokens: DataFrame) -> DataFrame:
    """Counts of neighbouring characters, as ``pair``, in ``tokens(token, weight)``."""
    at = F.sequence(F.lit(1), F.length("token") - 1)
    pair = F.transform(at, lambda i: F.substring(F.col("token"), i, F.lit(2)))
    return tokens.where(F.length("token") > 1).select(F.explode(pair).alias("pair"), "weight").groupBy("pair").agg(F.sum("weight").alias("n"))


def _log_model(rows: list, smooth: float) -> list[list[float]]:
    """Log probabilities of the second character given the first, backed off to those of any character."""
    k = len(ALPHABET)
    table = [[0.0] * k for _ in range(k)]
    at = {c: i for i, c in enumerate(ALPHABET)}
    for r in rows:
        if r["pair"][0] in at and r["pair"][1] in at:
            table[at[r["pair"][0]]][at[r["pair"][1]]] += r["n"]
    total = [1.0 + sum(row[i] for row in table) for i in range(k)]
    usual = [n / sum(total) for n in total]
    return [[math.log((v + smooth * u) / (sum(row) + smooth)) for v, u in zip(row, usual, strict=True)] for row in table]


def train(secret: DataFrame, tokens: DataFrame) -> list[float]:
    """Log-likelihood ratios (random against ordinary) by pair of characters, row by row of ALPHABET.

    ``secret(token)``: distinct values of the patterns; ``tokens(token, n)``: distinct tokens outside them, with their occurrences.
    """
    mixed = F.col("token").rlike("[0-9]") & F.col("token").rlike("[A-Za-z]")
    # what looks most like a secret teaches neither model
    plain = tokens.where("n > 0").where(~((F.length("token") >= MIN_UNTAUGHT) & mixed)).withColumn("weight", F.sqrt("n"))
    secret = secret.where(mixed).withColumn("weight", F.lit(1.0))
    known = F.col("pair").rlike("^" + TOKEN[:-1] + "{2}$")
    random, usual = (_log_model(_pairs(t).where(known).collect(), smooth)       # a row per pair of characters
                     for t, smooth in ((secret, SMOOTH_RANDOM), (plain, SMOOTH)))
    return [x - y for a, b in zip(random, usual, strict=True) for x, y in zip(a, b, strict=True)]


def ratio(token: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of a token of ALPHABET characters: a look-up by character codes for each pair."""
    k, by_code = len(ALPHABET), [0.0] * (128 * 128)
    for i, a in enumerate(ALPHABET):
        for j, b in enumerate(ALPHABET):
            by_code[ord(a) * 128 + ord(b)] = model[i * k + j]
    table = F.split(F.lit(",".join(f"{v:.5f}" for v in by_code)), ",").cast("array<double>")   # folded to a literal

    def step(sum_: Column, i: Column) -> Column:
        pair = F.substring(token, i, F.lit(2))
        return sum_ + F.get(table, F.ascii(pair) * 128 + F.ascii(F.substring(pair, 2, 1)))

    return F.aggregate(F.sequence(F.lit(1), F.length(token) - 1), F.lit(0.0), step)


def flagged_tokens(tokens: DataFrame, model: list[float]) -> DataFrame:
    """The distinct tokens that the models call random: the longer a token, the more nats it needs."""
    n = F.length("token")
    return tokens.where(n >= MIN_TOKEN).where(ratio(F.col("token"), model) >= F.greatest(F.lit(MIN_RATIO), MIN_RATE * n))


def _key(df: DataFrame) -> DataFrame:
    """A key of the row's id and text: rows equal in both hold the same secrets."""
    of_id = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit("null"))
    return df.withColumn("key", F.concat_ws(":", of_id, F.length("text"), F.xxhash64("text")))


def token_places(docs: DataFrame, flagged: DataFrame) -> DataFrame:
    """Per document (by its key) with flagged tokens: ``markov``, their spans."""
    long_token = r"[A-Za-z0-9+/_=-]{%d,}" % MIN_TOKEN
    rows = _key(docs.select("doc_id", _text()))
    held = (rows.select("key", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(long_token), F.lit(0)))).alias("token"))
            .join(flagged, "token", "left_semi").groupBy("key").agg(F.collect_set("token").alias("held")))   # of one text
    # a pattern of the document's own tokens, as whole runs; the alphabet needs no quoting but in + - / =
    runs = F.concat(F.lit(r"(?<![A-Za-z0-9+/_=-])(?:\Q"), F.array_join("held", r"\E|\Q"), F.lit(r"\E)(?![A-Za-z0-9+/_=-])"))
    at = rows.select("key", "text").join(held, "key").groupBy("key").agg(F.first("text").alias("text"), F.first(runs).alias("runs"))
    return at.select("key", spans(F.col("text"), F.col("runs")).alias("markov"))


def secrets(docs: DataFrame) -> DataFrame:
    """Per row of ``docs(doc_id, text, ...)``: doc_id, n_assign, n_access, n_hex, n_markov, base_sha256, spans.

    Null texts count as empty; rows with a null or repeated doc_id are scanned
    like any other; without any base match the random model is uniform; an
    empty table gives no rows; other columns are ignored.
    """
    found = save(_key(base_spans(docs)).select("doc_id", "key", "assign", "access", "hex", _values().alias("values")), "base_spans")
    tokens = save(distinct_tokens(docs), "tokens")
    model = train(found.select(F.explode("values").alias("token")).distinct(), tokens)
    flagged = save(flagged_tokens(tokens, model), "flagged")
    places = token_places(docs, flagged)
    base = F.concat("assign", "access", "hex")
    free = lambda s: ~F.exists(base, lambda b: (b["s"] < s["e"]) & (s["s"] < b["e"]))
    out = (found.join(places, "key", "left")
           .withColumn("markov", F.filter(F.coalesce("markov", F.array().cast(_SPANS)), free)))
    kinds = ("assign", "access", "hex", "markov")

    def named(k: int, n: str):
        return lambda s: F.struct(s["s"].alias("s"), F.lit(k).alias("k"), s["e"].alias("e"), F.lit(n).alias("n"))

    def listed(names: tuple[str, ...]) -> Column:
        rows = F.concat(*[F.transform(n, named(k, n)) for k, n in enumerate(names)])
        return F.concat_ws(",", F.transform(F.array_sort(rows), lambda r: F.concat_ws(":", r["n"], r["s"], r["e"])))

    return out.select("doc_id", *[F.size(n).cast("bigint").alias(f"n_{n}") for n in kinds],
                      F.sha2(listed(kinds[:3]).cast("binary"), 256).alias("base_sha256"), listed(kinds).alias("spans"))
