"""Personal data by weak supervision.

Four kinds are certain by their form (``BASE``). Further candidates, which form
alone does not decide, get votes from labelers: the shape, words before them, a
gazetteer, their variety and their surroundings; each votes for, against or
abstains. Expectation-maximisation over the counts of vote patterns estimates
how reliable each labeler is, without any labels, and a posterior per pattern.
A logistic span classifier is fitted to the posteriors and judges every
candidate as one more expression of the projection.

Texts are scanned by built-in functions only. Candidates are written as one
narrow row per document; what reaches the driver is the histogram of vote
patterns, at most ``3 ** labelers`` per kind whatever the corpus.

Spans count code points, end exclusive. NULL and empty texts have none. Rows are
judged one by one, so repeated ids and ties do not matter. Without candidates
nothing is fitted. An empty table gives an empty result; further columns of the
input are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Scratch, attach, let, total

# Quantifiers are possessive where giving back never helps, so that scanning is
# linear and long runs do not nest; a match starts where its run does or where
# the last match ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BYTE = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
SHORT_CONTEXT = 40
ROUNDS = 50


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(text: Column) -> Column:
    """Whether the check digit holds: every second digit from the right counts double, digit by digit."""
    def holds(digits: Column) -> Column:
        def weighed(i: Column) -> Column:
            digit = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
            double = digit * 2
            return F.when(i % 2 == 0, digit).when(double > 9, double - 9).otherwise(double).cast("bigint")

        return F.pmod(total(F.transform(F.sequence(F.lit(0), F.length(digits) - 1), weighed)), F.lit(10)) == 0

    return let(_digits(text), holds)


def _count_digits(text: Column, low: int, high: int) -> Column:
    return F.length(_digits(text)).between(low, high)


# kind, pattern, what a text with a match surely holds, and which matches count
BASE = (
    ("email", EMAIL, "@", lambda m: F.lit(True)),
    ("ip", IP, r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", lambda m: m.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")),
    ("card", CARD, r"[0-9](?:[\x20-]?[0-9]){11}", lambda m: F.when(_count_digits(m, 12, 19), _luhn(m)).otherwise(False)),
    ("phone", PHONE, r"\+[0-9]", lambda m: _count_digits(m, 9, 15)),
)


@dataclass(frozen=True)
class Candidate:
    """A kind of span that form alone does not decide, and what its labelers look for."""

    kind: str
    pattern: str
    hint: str
    shape: str
    cues: str
    gazetteer: str


CANDIDATES = (
    Candidate(
        "phone", r"(?<![0-9+.-])\(?[0-9]{2,5}\)?[\x20./-][0-9]{2,5}(?:[\x20./-][0-9]{2,5}){1,3}(?![0-9])", r"[0-9][)\x20./-]",
        r"^(?:[^0-9]*[0-9]){9,13}[^0-9]*$", r"(?i)(?:call|phone|tel|mobil|fax|contact|appel|ruf|llam)\p{L}*[.:]?\W*$", r"^\(?(?:0|[2-9][0-9]{2}\b)",
    ),
    Candidate(
        "national_id", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]-[0-9]{2}-",
        r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)", r"(?i)(?:ssn|social security|id|tax)\W*(?:no|number|nr)?\W*$", r"^[0-7]",
    ),
    Candidate(
        "secret", r"""(?<![A-Za-z0-9])(?:(?i:password|passwd|secret|token|api[_-]?key)\x20?[=:]\x20?"?[^\s"]{8,}"?|AKIA[0-9A-Z]{16}(?![A-Za-z0-9]))""", r"[=:]|AKIA",
        r"[0-9].*[A-Za-z]|[A-Za-z].*[0-9]", r"(?i)(?:login|user|key|access|secret|with|und|and|et|y)\W*$", r"(?i)^(?:password|passwd|token|secret|api|AKIA)",
    ),
    Candidate(
        "hidden_email", r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]+(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]+)+", r"(?i)[\[(]at[\])]",
        r"^\S{2,64}\s?[\[(]", r"(?i)(?:mail|write|contact|reach)\p{L}*\W*$", r"(?i)(?:com|org|net|de|fr|es|io|edu)$",
    ),
    Candidate(
        "name", r"(?<!\p{L})(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Mme|Señora?|Sra?)\.?\x20\p{Lu}\p{Ll}+(?:\x20\p{Lu}\p{Ll}+)?", r"(?:r|s|f|u|e|a)\.?\x20\p{Lu}",
        r"\p{Lu}\p{Ll}+\x20\p{Lu}\p{Ll}+$", r"(?i)(?:dear|sincerely|name|contact|by|von|par|por)\W*$", r"^(?:Mr|Mrs|Ms|Dr|Prof)",
    ),
)
LABELERS = ("shape", "context", "gazetteer", "variety", "edges")
AGAINST = r"(?i)(?:version|v|page|isbn|chapter|section|figure|no|id|build)\W*$"
KINDS = {kind: i for i, kind in enumerate([name for name, *_ in BASE] + [c.kind for c in CANDIDATES if c.kind != "phone"])}


def matches(text: Column, pattern: str, hint: str) -> Column:
    """(start, end, match) of the leftmost non-overlapping matches.

    The pieces between matches and the matches, in turn, make up the text, so
    their lengths give the places.
    """
    def placed(found: Column, pieces: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,match:string>>").alias("spans"))

        def step(acc: Column, i: Column) -> Column:
            match = F.get(found, i)
            begin = acc["at"] + F.length(F.get(pieces, i))
            span = F.struct(begin.alias("start"), (begin + F.length(match)).alias("end"), match.alias("match"))
            return F.struct(span["end"].alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

        order = F.sequence(F.lit(0), F.size(found) - 1)
        return F.when(F.size(found) == 0, start["spans"]).otherwise(F.aggregate(order, start, step)["spans"])

    scanned = let(
        F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern).alias("pieces")),
        lambda s: placed(s["found"], s["pieces"]),
    )
    return F.when(text.rlike(hint), scanned).otherwise(F.array().cast("array<struct<start:int,end:int,match:string>>"))


def _kept(kind: str, spans: Column, counts) -> Column:
    good = F.filter(spans, lambda s: counts(s["match"]))
    return F.transform(good, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS[kind]).alias("order"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def base_spans(text: Column) -> Column:
    """(start, order, end, kind) of the certain kinds."""
    return F.sort_array(F.concat(*[_kept(kind, matches(text, pattern, hint), counts) for kind, pattern, hint, counts in BASE]))


def _vote(condition: Column, otherwise: int = 0) -> Column:
    return F.when(condition, 1).otherwise(otherwise)


def candidate_spans(text: Column) -> Column:
    """(start, order, end, kind, candidate, votes) of the uncertain kinds."""
    def voted(n: int, c: Candidate, spans: Column) -> Column:
        def one(s: Column) -> Column:
            low = F.greatest(s["start"] - SHORT_CONTEXT, F.lit(0))
            before = F.substr(text, low + 1, s["start"] - low)
            around = F.concat(F.substr(text, F.greatest(s["start"], F.lit(1)), F.when(s["start"] > 0, 1).otherwise(0)), F.substr(text, s["end"] + 1, F.lit(1)))
            letters = F.size(F.array_distinct(F.split(F.regexp_replace(s["match"], r"\W", ""), "")))
            votes = F.concat_ws(
                ",",
                _vote(s["match"].rlike(c.shape), -1),
                let(before, lambda b: F.when(b.rlike(c.cues), 1).when(b.rlike(AGAINST), -1).otherwise(0)),
                _vote(s["match"].rlike(c.gazetteer)),
                _vote(letters >= 4, -1),
                _vote(around.rlike(r"^[\s\p{P}]*$"), -1),
            )
            return F.struct(
                s["start"].alias("start"), F.lit(KINDS[c.kind]).alias("order"), s["end"].alias("end"), F.lit(c.kind).alias("kind"),
                F.lit(n).alias("candidate"), votes.alias("votes"),
            )

        return F.transform(spans, one)

    return F.sort_array(F.concat(*[voted(n, c, matches(text, c.pattern, c.hint)) for n, c in enumerate(CANDIDATES)]))


def estimate(histogram: dict[tuple[int, ...], int], rounds: int = ROUNDS) -> tuple[list[dict[int, float]], float, dict[tuple[int, ...], float]]:
    """Expectation-maximisation over vote patterns of one kind.

    Gives each labeler's log-odds per vote, the prior, and the posterior per
    pattern. It starts from the majority vote; a labeler's chances of each vote
    given the truth are smoothed by one count each.
    """
    posterior = {p: min(0.9, max(0.1, 0.5 + 0.15 * sum(p))) for p in histogram}
    everything = sum(histogram.values())
    odds: list[dict[int, float]] = []
    prior = 0.5
    for _ in range(rounds):
        true = sum(posterior[p] * n for p, n in histogram.items())
        prior = min(0.99, max(0.01, (true + 1) / (everything + 2)))
        odds = []
        for i in range(len(next(iter(histogram)))):
            hits: dict[tuple[int, bool], float] = defaultdict(float)
            for p, n in histogram.items():
                hits[p[i], True] += posterior[p] * n
                hits[p[i], False] += (1 - posterior[p]) * n
            good = {v: (hits[v, True] + 1) / (true + 3) for v in (-1, 0, 1)}
            bad = {v: (hits[v, False] + 1) / (everything - true + 3) for v in (-1, 0, 1)}
            # No labeler is taken to be wrong more often than right: its vote for never counts against.
            raw = {v: math.log(good[v] / bad[v]) for v in (-1, 0, 1)}
            odds.append({-1: min(0.0, raw[-1]), 0: 0.0, 1: max(0.0, raw[1])})
        start = math.log(prior / (1 - prior))
        posterior = {p: 1 / (1 + math.exp(-max(-30.0, min(30.0, start + sum(o[v] for o, v in zip(odds, p)))))) for p in histogram}
    return odds, prior, posterior


def span_classifier(histogram: dict[tuple[int, ...], int], posterior: dict[tuple[int, ...], float], steps: int = 400, rate: float = 0.5) -> list[float]:
    """Logistic weights (bias first, then for and against of each labeler) fitted to the posteriors."""
    rows = [(p, n, posterior[p]) for p, n in histogram.items()]
    everything = sum(n for _, n, _ in rows)
    weights = [0.0] * (1 + 2 * len(rows[0][0]))
    for _ in range(steps):
        gradient = [1e-3 * w for w in weights]
        for p, n, q in rows:
            x = features(p)
            z = sum(w * v for w, v in zip(weights, x))
            error = (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - q) * n / everything
            gradient = [g + error * v for g, v in zip(gradient, x)]
        weights = [w - rate * g for w, g in zip(weights, gradient)]
    return weights


def features(pattern: tuple[int, ...]) -> list[float]:
    return [1.0] + [float(v == 1) for v in pattern] + [float(v == -1) for v in pattern]


def vote_histogram(found: DataFrame) -> dict[int, dict[tuple[int, ...], int]]:
    """Vote patterns of the candidates that no certain span overlaps, by candidate; bounded by the patterns there can be."""
    counts = found.select(F.explode("candidates").alias("c")).groupBy("c.candidate", "c.votes").count().collect()
    histogram: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)
    for row in counts:
        histogram[row["candidate"]][tuple(map(int, row["votes"].split(",")))] = row["count"]
    return histogram


def accepted_patterns(histogram: dict[int, dict[tuple[int, ...], int]], least: float = 0.5) -> dict[int, list[str]]:
    """The vote patterns the trained classifier accepts, by candidate."""
    accepted = {}
    for n, counts in histogram.items():
        _, _, posterior = estimate(counts)
        weights = span_classifier(counts, posterior)
        scores = {p: sum(w * v for w, v in zip(weights, features(p))) for p in counts}
        accepted[n] = sorted(",".join(map(str, p)) for p, z in scores.items() if 1 / (1 + math.exp(-z)) >= least)
    return accepted


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find_personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``base`` and ``spans`` (start, order, end, kind) per row, ``spans`` with the accepted candidates. Runs jobs."""
    scratch = Scratch(docs.sparkSession, "pii")
    held = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    scanned = held.select("key", base_spans(F.col("text")).alias("base"), candidate_spans(F.col("text")).alias("candidates"))
    free = F.filter("candidates", lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    found = scratch.write("found", scanned.withColumn("candidates", free))
    accepted = [f"{n}:{p}" for n, patterns in accepted_patterns(vote_histogram(found)).items() for p in patterns]
    chosen = F.filter("candidates", lambda c: F.concat_ws(":", c["candidate"], c["votes"]).isin(accepted))
    plain = F.transform(chosen, lambda c: F.struct(c["start"].alias("start"), c["order"].alias("order"), c["end"].alias("end"), c["kind"].alias("kind")))
    return found.select(F.col("key").alias(key), "base", F.sort_array(F.concat("base", plain)).alias("spans"))


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of the certain kinds, the hash of their spans, and all spans as text."""
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(kind) for kind, *_ in BASE]
    return found.select(key, *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def mask(docs: DataFrame, key: str = "doc_id", text: str = "text", placeholder: str = "[{}]") -> DataFrame:
    """The rows with every span replaced by its kind; of overlapping ones the first."""
    scratch = Scratch(docs.sparkSession, "pii-mask")
    numbered = docs.select(F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("version")).alias("row"), F.col(text).alias("text"))
    found = find_personal_data(numbered, "row", "text").where(F.size("spans") > 0).select("row.key", "row.version", "spans").distinct()
    joined_rows, (spans,) = attach(docs, key, F.xxhash64(text), scratch.write("found", found), scratch)

    def replaced(held: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
        before, after = placeholder.split("{}")

        def step(acc: Column, s: Column) -> Column:
            gap = F.substr(held, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
            covered = s["start"] < acc["at"]
            out = F.concat(acc["out"], gap, F.lit(before), s["kind"], F.lit(after))
            return F.struct(F.greatest(s["end"], acc["at"]).alias("at"), F.when(covered, acc["out"]).otherwise(out).alias("out"))

        done = F.aggregate(spans, start, step)
        return let(done, lambda d: F.concat(d["out"], F.substr(held, d["at"] + 1, F.length(held))))

    return joined_rows.withColumn(text, F.when(F.col(spans).isNull(), F.col(text)).otherwise(replaced(F.col(text)))).drop(spans)
