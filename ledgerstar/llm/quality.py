"""Weak supervision of document quality.

Rules over surface features vote good (1), bad (-1) or abstain (0). No label
is read: expectation-maximisation over the votes of all documents estimates
the share of good documents and how often each rule votes either way on good
documents and on bad ones of every kind, and so the accuracy of its votes. A document is kept by its posterior probability
of being good, not by passing every rule.

EM needs only how often each vote pattern occurs. Spark counts the patterns
(at most 3 ** number of rules, whatever the number of documents); that table
alone reaches the driver, and the posterior of each pattern goes back to the
documents by a join.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_out, arrow_rows, written

WINDOW_WORDS = 5
MIN_WORDS = 10
#: base_failed beyond this percentage of words in repeated windows.
REPEAT_PERCENT = 20
KEEP_POSTERIOR = 0.5
_SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
_SYMBOLS = b"#*$%&|<>"
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_LETTER_WORD = re.compile(rb"[A-Za-z\x80-\xff][^\x20\x09-\x0d]*")
#: A run of three or more symbols that hangs on a word; Markdown and code hang two at most.
_STREWN = re.compile(rb"[A-Za-z\x80-\xff][.,;:!?]?[#*$%&|<>]{3}")
#: Sentence-final marks of all scripts; quotes and brackets that close beyond ASCII.
_ALL = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x20000)]))
_FINAL = frozenset(x.encode() for x in [*regex.findall(r"\p{Sentence_Terminal}", _ALL), *regex.findall(r"[[^\x00-\x7f]&&[\p{Pe}\p{Pf}]]", _ALL, regex.V1),
                                        *".!?:;…\"')：；"])
del _ALL
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct",
            "n_letter_words", "n_upper", "n_lower", "n_ended_lines", "n_strewn")


def _ended(line: bytes) -> bool:
    """Whether the line's last character, but white space, ends a sentence."""
    line = line.rstrip()
    size = next((k for k in (1, 2, 3) if line[-k] & 0xC0 != 0x80 or k == len(line)), 4)
    return line[-size:] in _FINAL


def _count(raw: bytes, chars: bytes) -> int:
    return len(raw) - len(raw.translate(None, chars))


def repeated_window_words(ids: np.ndarray, n_distinct: int, window: int = WINDOW_WORDS) -> int:
    """Words inside windows of ``window`` words that occur twice or more.

    Windows are compared exactly: positions get the rank of their window of
    one word, then of two, and so on, so a key never mixes two windows.
    """
    n = len(ids) - window + 1
    if n < 2:
        return 0
    key, base = ids[:n].astype(np.int64), int(n_distinct)
    span = base
    for k in range(1, window):
        if span > (1 << 62) // base:
            seen, key = np.unique(key, return_inverse=True)
            span = len(seen)
        key = key * base + ids[k:k + n]
        span *= base
    order = np.argsort(key, kind="stable")
    in_order = key[order]
    same = in_order[1:] == in_order[:-1]
    starts = order[np.r_[same, False] | np.r_[False, same]]
    if not len(starts):
        return 0
    edge = np.zeros(len(ids) + 1, np.int64)
    edge[starts] += 1
    edge[starts + window] -= 1
    return int((np.cumsum(edge) > 0).sum())


def features(text: str | None) -> tuple[int, ...]:
    """The counts named in FEATURES; all zero for a null or empty text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes.split parts at \x20 and \x09-\x0D, no other space
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (len(words), len(text) - _count(raw, _SPACES), _count(raw, _SYMBOLS), len(lines) - len(set(lines)),
            repeated_window_words(ids, len(number)), len(lines), len(number), len(_LETTER_WORD.findall(raw)),
            _count(raw, _UPPER), _count(raw, _LOWER), sum(map(_ended, lines)),
            len(_STREWN.findall(raw)))


@dataclass(frozen=True)
class Rule:
    """Votes -1 where ``bad`` holds, 1 where ``good`` holds, 0 elsewhere.
    Both are SQL conditions over FEATURES."""

    name: str
    bad: str
    good: str
    #: Whether documents it votes against are a kind of bad ones; if not (good code, tables, lists and unspaced scripts set it off), its votes only add to what others find.
    kind: bool = True


RULES = (
    Rule("length", "n_words < 10", "n_words >= 50"),
    Rule("symbols", "10 * n_symbols > n_words", "100 * n_symbols <= n_words and n_words >= 10", kind=False),
    Rule("strewn", "20 * n_strewn > n_words", "100 * n_strewn <= n_words and n_words >= 10"),
    Rule("dup_lines", "5 * n_dup_lines > 2 * n_lines", "n_lines >= 3 and 20 * n_dup_lines <= n_lines"),
    Rule("repeats", "5 * n_repeat_words > n_words", "n_words >= 20 and 20 * n_repeat_words <= n_words"),
    Rule("word_length", "word_chars < 3 * n_words or word_chars > 12 * n_words",
         "word_chars >= 4 * n_words and word_chars <= 8 * n_words and n_words >= 10", kind=False),
    Rule("distinct", "n_words >= 20 and n_distinct * n_distinct < 4 * n_words", "n_words >= 20 and n_distinct * n_distinct > 25 * n_words"),
    Rule("capitals", "2 * n_upper > n_upper + n_lower", "n_lower >= 40 and 10 * n_upper < n_upper + n_lower"),
    Rule("letters", "n_words >= 20 and 10 * n_letter_words < 7 * n_words", "n_words >= 10 and 20 * n_letter_words > 19 * n_words"),
    Rule("line_ends", "n_lines >= 3 and 5 * n_ended_lines < n_lines", "n_lines >= 1 and 10 * n_ended_lines > 8 * n_lines and n_words >= 10", kind=False),
)


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = 500, tolerance: float = 1e-9, kinds: Sequence[bool] | None = None) -> tuple[float, dict[str, np.ndarray], np.ndarray]:
    """EM over vote patterns (rows of ``votes``) that occur ``counts`` times.

    Documents are good, or bad of one kind per rule (that ``kinds`` holds, by
    default every rule): documents that a rule
    was written against set off that rule nearly always and others at rates
    of their own, which EM estimates for every kind as for the good ones.
    Rules that vote bad have each found something, so those votes, and their
    absence, add up. Rules that find nothing wrong say much the same thing,
    so their votes count together as one, by the mean of their log rates. Ten
    imagined documents of each kind keep rates off zero. How often a rule votes
    bad on good documents is estimated like every other rate.

    Returns the share of good documents, the accuracy of each rule's bad and
    good votes, and each pattern's posterior of being good.
    """
    bad, good = (votes == -1).astype(float), (votes == 1).astype(float)
    n_good = np.maximum(good.sum(axis=1, keepdims=True), 1)
    m = votes.shape[1]
    own = np.eye(m)[np.array([True] * m if kinds is None else kinds)]
    b = len(own)
    fires = np.vstack([np.full((1, m), 0.005), 0.05 + 0.85 * own])
    clears = np.vstack([np.full((1, m), 0.9), np.full((b, m), 0.7)])
    share = np.r_[0.8, np.full(b, 0.2 / b)]
    prior_fires, prior_clears, posterior = fires.copy(), clears.copy(), np.zeros((len(votes), b + 1))
    for _ in range(rounds):
        logs = np.log(share) + bad @ np.log(fires.T) + (1 - bad) @ np.log(1 - fires.T) + good @ np.log(clears.T) / n_good
        new = np.exp(logs - logs.max(axis=1, keepdims=True, initial=-np.inf))
        new /= new.sum(axis=1, keepdims=True)
        done = np.abs(new - posterior).max(initial=0) < tolerance
        posterior = new
        if done:
            break
        weight = posterior * counts[:, None]
        size = weight.sum(axis=0)[:, None] + 10
        fires = (weight.T @ bad + 10 * prior_fires) / size
        clears = (weight.T @ good + 10 * prior_clears) / size
        share = size[:, 0] / size.sum()
    p = posterior[:, 0]
    cast = {"bad": bad.T @ counts, "good": good.T @ counts}
    right = {"bad": bad.T @ (counts * (1 - p)), "good": good.T @ (counts * p)}
    return float(share[0]), {k: right[k] / np.maximum(cast[k], 1) for k in cast}, p


def document_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), *((f, pa.int64()) for f in FEATURES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return arrow_out(schema, ((i, *features(t)) for i, t in arrow_rows(batches)))

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, ", ".join(f"{n} long" for n in schema.names)))


def score(docs: DataFrame, rules: tuple[Rule, ...] = RULES, threshold: float = KEEP_POSTERIOR, id_col: str = "doc_id",
          text_col: str = "text", report: Callable[[dict], None] | None = None) -> DataFrame:
    """doc_id, FEATURES, pattern, base_failed, posterior, kept per row.

    A null or empty text has no words: it fails the base rules. Repeated rows
    and ids, null ids and ties are judged row by row, alike rows alike. Other
    columns are ignored. An empty table gives no rows. ``report`` gets the
    estimated share of good documents and the accuracies of each rule's votes.
    """
    spark = docs.sparkSession
    digits = [F.expr(f"case when {r.bad} then '0' when {r.good} then '2' else '1' end") for r in rules]
    seen = written(document_features(docs, id_col, text_col).withColumn("pattern", F.concat(*digits)), "features")
    counted = sorted((r["pattern"], r["count"]) for r in seen.groupBy("pattern").count().collect())
    votes = np.array([[int(c) - 1 for c in p] for p, _ in counted], np.int64).reshape(-1, len(rules))
    share, accuracy, posterior = estimate(votes, np.array([n for _, n in counted], float), kinds=[r.kind for r in rules])
    if report:
        report({"good": share, "rules": {r.name: {k: float(v[i]) for k, v in accuracy.items()} for i, r in enumerate(rules)}})
    known = spark.createDataFrame([(p, float(x)) for (p, _), x in zip(counted, posterior, strict=True)], "known string, posterior double")
    base = F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {REPEAT_PERCENT} * n_words")
    # one row per vote pattern: at most 3 ** len(rules) rows
    return (seen.join(F.broadcast(known), F.col("pattern") == F.col("known")).drop("known")
            .withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold)))
