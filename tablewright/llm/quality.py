"""Quality rules combined by weak supervision.

Method: every rule votes good (1), bad (-1) or abstains (0) on a text. Expectation-maximisation over the
counts of vote patterns estimates the share of good texts and, for each class and rule, how often it votes
good, votes bad and abstains; the posterior probability of "good" then replaces passing every rule, so that
a bad vote of a rule that is often wrong is outvoted. The patterns are at most 3 ** (number of rules)
whatever the input, so that many counts at most reach the driver; all rows are counted.

Abstentions are estimated and reported, and leave the odds alone: rules abstain on short texts, and that a
text is short is no sign of its quality.

Words are runs of characters other than ASCII white space. Windows of five words are compared by 64-bit
hashes.

Defined cases: a null or empty text has no words, all counts are 0, it fails the base rules and is not kept.
With an empty table the tables and the share are those that the estimate starts from. A text on which no
rule votes has the estimated share as its posterior. An input column that has the name of a result is
replaced, as withColumn does; ``set_aside`` keeps it.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.common import map_columns

WINDOW = 5
SYMBOLS = "#*$%&|<>"
FEATURES = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_distinct_words n_upper_words n_letters n_common_words n_full_stops n_links".split()
)
# Fixed: the commonest function words of English, German, French and Spanish.
COMMON = frozenset(
    "the of and to in a is that for it was on are as with at be this by from or an have not "
    "der die das und ist nicht von zu mit den ein eine im für auf des dem sich "
    "le la les un une est et que qui du dans pour par sur pas au en "
    "el los las una y es por con para del se no su al lo".encode().split()
)
NO_LETTERS = bytes(i for i in range(128) if not chr(i).isalpha())
MIX = np.uint64(0x9E3779B97F4A7C15)
# Of the expectation-maximisation: rounds at most, the share of good texts that it starts with, P(vote good), P(vote
# bad) of a good and a bad text (a bad one shows some faults, not all), and the votes a class that this counts for.
ROUNDS, SHARE, START, PRIOR_VOTES = 500, 0.8, ((0.95, 0.05), (0.6, 0.4)), 5.0


def windows(codes: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """64-bit hashes of all runs of ``width`` codes."""
    n = len(codes) - width + 1
    if n <= 0:
        return codes[:0]
    out = codes[:n].copy()
    for i in range(1, width):
        out = (out ^ (out >> np.uint64(29))) * MIX + codes[i : i + n]
    out ^= out >> np.uint64(32)
    return out * MIX


def repeated_words(codes: np.ndarray) -> int:
    """Words inside a window that occurs at least twice in the text, the first occurrence included."""
    keys = windows(codes)
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(codes) + 1, np.int64)
    np.add.at(covered, np.flatnonzero(twice), 1)
    np.add.at(covered, np.flatnonzero(twice) + WINDOW, -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The values of FEATURES for one text."""
    if not text:
        return (0,) * len(FEATURES)
    raw = text.encode()
    words = raw.split()  # bytes are split at ASCII white space only
    n = len(words)
    if not n:
        return (0, 0, sum(map(text.count, SYMBOLS))) + (0,) * (len(FEATURES) - 3)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    # Hashes of byte strings agree within a process, and windows are only compared within a text.
    repeats = repeated_words(np.fromiter(map(hash, words), np.int64, n).view(np.uint64)) if n > WINDOW else 0
    first = np.frombuffer(bytes(map(itemgetter(0), words)), np.uint8)
    return (
        n,
        len(text) - sum(map(text.count, " \t\n\v\f\r")),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeats,
        len(lines),
        len(set(words)),
        int(((first >= 65) & (first <= 90)).sum()),
        len(raw.translate(None, NO_LETTERS).decode()),
        sum(map(COMMON.__contains__, raw.lower().split())),
        raw.count(b"."),
        raw.count(b"://"),
    )


def features(df: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """Add the counts named in FEATURES as bigint columns."""

    def make(texts: pa.Array) -> dict[str, pa.Array]:
        found = np.array([measure(t) for t in texts.to_pylist()], np.int64).reshape(-1, len(FEATURES))
        return {name: pa.array(found[:, i]) for i, name in enumerate(FEATURES)}

    return map_columns(df, text, [(name, T.LongType()) for name in FEATURES], make, keep_text)


def base_failed() -> Column:
    n, repeats = F.col("n_words"), F.col("n_repeat_words")
    return (n < 10) | (100 * repeats > 20 * n)


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """Votes in terms of FEATURES; integer comparisons, so that every engine agrees. A rule votes where its
    measure is clear, one way or the other, and abstains between and on texts too short for it."""
    n, chars, symbols = F.col("n_words"), F.col("word_chars"), F.col("n_symbols")
    dup, repeats, lines = F.col("n_dup_lines"), F.col("n_repeat_words"), F.col("n_lines")
    distinct, upper, letters = F.col("n_distinct_words"), F.col("n_upper_words"), F.col("n_letters")
    common, stops, links = F.col("n_common_words"), F.col("n_full_stops"), F.col("n_links")
    return {
        "word_length": _vote(chars.between(4 * n, 6 * n), (chars > 10 * n) | (chars < 3 * n)),
        "letters": _vote(100 * letters >= 92 * chars, 100 * letters < 80 * chars),
        "symbols": _vote(100 * symbols <= n, 10 * symbols > n),
        "common_words": _vote((n >= 30) & (100 * common >= 15 * n), (n >= 30) & (100 * common < 8 * n)),
        "repeats": _vote((n >= 30) & (100 * repeats <= 2 * n), (n >= 10) & (100 * repeats > 10 * n)),
        "lines": _vote((lines >= 3) & (dup == 0), (lines >= 2) & (4 * dup > lines)),
        "variety": _vote((n >= 30) & (100 * distinct >= 40 * n), (n >= 30) & (100 * distinct < 25 * n)),
        "capitals": _vote((n >= 30) & (100 * upper).between(2 * n, 20 * n), (n >= 10) & (100 * upper > 50 * n)),
        "sentences": _vote((n >= 30) & n.between(5 * stops, 30 * stops), (n >= 30) & ((n < 2 * stops) | (n > 60 * stops))),
        "links": _vote((n >= 100) & (links == 0), 20 * links > n),
    }


@dataclass(frozen=True)
class QualityModel:
    """The share of good texts, and for each rule by class (good, bad) how often it votes good and bad where it votes,
    and how often it abstains."""

    share: float
    votes: dict[str, tuple[tuple[float, float], tuple[float, float]]]
    silent: dict[str, tuple[float, float]]

    def tables(self) -> dict[str, list[tuple[float, float, float]]]:
        """P(vote | class) of each rule: rows good and bad, columns the votes good, bad and none."""
        return {n: [(g * (1 - none), b * (1 - none), none) for (g, b), none in zip(self.votes[n], self.silent[n], strict=True)] for n in self.votes}

    def weights(self) -> dict[str, tuple[float, float]]:
        """Log odds that a good and a bad vote of each rule give, among the texts on which it votes."""
        return {n: (float(np.log(g1 / g2)), float(np.log(b1 / b2))) for n, ((g1, b1), (g2, b2)) in self.votes.items()}

    def posterior(self) -> Column:
        """P(good | votes)."""
        odds = F.lit(float(np.log(self.share / (1 - self.share))))
        weights = self.weights()
        for name, vote in rules().items():
            yes, no = weights[name]
            odds = odds + F.when(vote == 1, yes).when(vote == -1, no).otherwise(0.0)
        return F.round(1 / (1 + F.exp(-odds)), 6)


def expectation_maximisation(votes: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[float, np.ndarray, np.ndarray]:
    """The share of good texts, P(vote | class, voted) by (rule, class, vote) and P(none | class) by (rule, class) from
    vote patterns: ``votes`` (pattern, rule) and ``counts`` (pattern). Rules err independently given the class.

    The start (SHARE, START) names the classes and counts for PRIOR_VOTES votes a class and rule; nothing else holds
    the estimates.
    """
    cast = np.stack([votes > 0, votes < 0], 2).astype(float)
    none = (votes == 0).astype(float)
    prior = PRIOR_VOTES * np.array(START)
    share, right = SHARE, np.broadcast_to(prior / PRIOR_VOTES, (votes.shape[1], 2, 2))
    for _ in range(rounds):
        logs = np.einsum("prv,rcv->pc", cast, np.log(right)) + np.log([share, 1 - share])
        good = 1 / (1 + np.exp(logs[:, 1] - logs[:, 0]))
        weight = counts[:, None] * np.stack([good, 1 - good], 1)
        seen = np.einsum("pc,prv->rcv", weight, cast) + prior
        new, before = seen / seen.sum(2, keepdims=True), share
        total = weight.sum(0) + PRIOR_VOTES * np.array([SHARE, 1 - SHARE])
        share = float(total[0] / total.sum())
        moved = max(np.abs(new - right).max(initial=0.0), abs(share - before))
        right = new
        if moved < 1e-10:
            break
    logs = np.einsum("prv,rcv->pc", cast, np.log(right)) + np.log([share, 1 - share])
    good = 1 / (1 + np.exp(logs[:, 1] - logs[:, 0]))
    weight = counts[:, None] * np.stack([good, 1 - good], 1)
    return share, right, np.einsum("pc,pr->rc", weight, none) / np.maximum(weight.sum(0), 1e-300)


def fit(measured: DataFrame) -> QualityModel:
    """Estimate the model from the vote patterns of all rows of a table with FEATURES that pass the base rules: on
    those alone the posterior decides, and the gross faults of the others would be the whole of the class "bad"."""
    names = list(rules())
    patterns = (
        measured.filter(~base_failed())
        .select(*[vote.alias(name) for name, vote in rules().items()])
        .groupBy(*names)
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(*names)
        .collect()
    )
    votes = np.array([[r[n] for n in names] for r in patterns], float).reshape(-1, len(names))
    share, right, silent = expectation_maximisation(votes, np.array([r["rows"] for r in patterns], float))
    table = {n: tuple(map(tuple, t.tolist())) for n, t in zip(names, right, strict=True)}
    return QualityModel(share, table, {n: tuple(t.tolist()) for n, t in zip(names, silent, strict=True)})


def judged(measured: DataFrame, model: QualityModel, least: float = 0.5) -> DataFrame:
    """Add base_failed, quality_posterior and kept: the base rules, then the posterior."""
    return (
        measured.withColumn("base_failed", base_failed())
        .withColumn("quality_posterior", model.posterior())
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality_posterior") >= least))
    )
