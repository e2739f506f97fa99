"""Language identification as mixture inference.

The model holds, for each language, the probabilities of hashed byte trigrams
of letters. A document's trigrams are taken as drawn from a mixture of
languages: expectation-maximisation estimates the proportions. Languages
enter the set one by one while the likelihood, less a penalty for each
language, rises. The prediction is the language with the largest proportion.

Counts are taken over all labelled documents outside the held-out fold. The
model has languages x BUCKETS numbers, however large the corpus. Up to
MAX_LANGUAGES it goes to every task as a whole. Beyond that the languages are
split into blocks by a hash, and the documents meet one block after the other:
what a document carries on is its selected set with the probabilities of its
own trigrams, so a task never holds more than one block, and a block's
languages compete with those selected before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_out, arrow_rows, written

BUCKETS = 1 << 15
#: Languages that go to every task at once (33 MB). More are split into blocks of half as many on average, so that the hash overfills none.
MAX_LANGUAGES = 256
#: Log-likelihood, times the logarithm of the number of trigrams, that each further language must win. Trigrams overlap: three share each letter.
PENALTY = 3.0
SMOOTHING = 0.1
UNKNOWN = "und"
#: ASCII other than letters becomes a space, A-Z lower case; other bytes stay.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the text's trigrams, ascending, and how often each occurs."""
    raw = b" " + b" ".join(text.encode("utf-8", "surrogatepass").translate(_FOLD).split()) + b" "
    a = np.frombuffer(raw, np.uint8).astype(np.uint32)
    code = (a[:-2] << np.uint32(16)) | (a[1:-1] << np.uint32(8)) | a[2:] if len(a) > 2 else a[:0]
    bucket = (code * np.uint32(2654435761)) >> np.uint32(17)
    if len(bucket) < 1500:
        at, n = np.unique(bucket, return_counts=True)
        return at.astype(np.int64), n
    n = np.bincount(bucket, minlength=BUCKETS)
    at = np.flatnonzero(n)
    return at, n[at]


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def counted(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """lang, bucket, n: how often each language's texts hold each bucket. Rows
    without a language or text teach nothing."""
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def drain():
            for lang, n in sums.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])], schema=schema)
            sums.clear()

        for lang, text in arrow_rows(batches):
            at, n = grams(text)
            if lang not in sums and len(sums) >= MAX_LANGUAGES:
                yield from drain()
            sums.setdefault(lang, np.zeros(BUCKETS, np.int64))[at] += n
        yield from drain()

    known = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).dropna()
    return known.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def model_of(counts: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages of ``counts``, sorted, and their log probabilities [language][bucket]."""
    langs: dict[str, np.ndarray] = {}
    for row in counts.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("model")).toLocalIterator():
        n = np.zeros(BUCKETS)
        for bucket, k in row["model"]:
            n[bucket] = k
        langs[row["lang"]] = n
    names = sorted(langs)
    totals = [langs[x] + SMOOTHING for x in names]
    return names, np.array([np.log(t / t.sum()) for t in totals]).reshape(len(names), BUCKETS)


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", most: int = MAX_LANGUAGES) -> list[tuple[list[str], np.ndarray] | DataFrame]:
    """The model in blocks: one that holds all languages, or, with more than
    ``most`` languages, the stored counts of each block, to be read when its
    turn comes."""
    held = written(counted(docs, lang_col, text_col), "langid-counts")
    languages = held.select("lang").distinct().count()
    if languages <= most:
        return [model_of(held)]
    n = -(-2 * languages // most)
    return [held.where(F.pmod(F.xxhash64("lang"), F.lit(n)) == k) for k in range(n)]


def learned(blocks: list) -> bool:
    """Whether a trained model knows any language."""
    return len(blocks) > 1 or bool(blocks[0][0])


def proportions(p: np.ndarray, n: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, float]:
    """EM: the mixture of the columns of ``p`` under which grams that occur
    ``n`` times are likeliest, and that log-likelihood."""
    share = np.full(p.shape[1], 1 / p.shape[1])
    total = n.sum()
    for _ in range(rounds):
        mixed = p @ share
        new = share * (p.T @ (n / mixed)) / total
        moved = np.abs(new - share).max()
        share = new
        if moved < 1e-4:
            break
    return share, float(n @ np.log(p @ share))


def infer(at: np.ndarray, n: np.ndarray, model: np.ndarray, penalty: float = PENALTY) -> tuple[dict[int, float], float]:
    """Proportions of the selected languages, and the score of the largest:
    its proportion in a mixture, its posterior if it stands alone."""
    chosen, share, alone = select(model[:, at], n, penalty)
    return {k: float(s) for k, s in zip(chosen, share, strict=True)}, _score(share, alone, chosen[0])


def select(logs: np.ndarray, n: np.ndarray, penalty: float) -> tuple[list[int], np.ndarray, np.ndarray]:
    """The selected languages with their proportions, and the likelihood of
    each language alone. ``logs``: [language][gram]."""
    alone = logs @ n
    best = int(np.argmax(alone))
    p = np.exp(logs - logs.max(axis=0)).T  # scaled by gram: the ratios decide
    base = float(n @ logs.max(axis=0))
    chosen, share, now = [best], np.ones(1), float(alone[best]) - base
    cost = penalty * np.log(max(2, n.sum()))
    while len(chosen) < len(logs):
        mixed = p[:, chosen] @ share
        slope = (n / mixed) @ p - n.sum()  # the likelihood is concave: without a rise at 0 there is none
        found = None
        for k in np.argsort(-slope, kind="stable"):
            if slope[k] <= cost or k in chosen:
                continue
            new, like = proportions(p[:, [*chosen, k]], n)
            if like > now + cost and (found is None or like > found[2]):
                found = (int(k), new, like)
        if found is None:
            break
        chosen, share, now = [*chosen, found[0]], found[1], found[2]
    return chosen, share, alone


def _score(share: np.ndarray, alone: np.ndarray, best: int) -> float:
    if len(share) > 1:
        return float(share.max())
    return float(1 / np.exp((alone - alone[best]) / 3).sum())


def predict(docs: DataFrame, blocks: list[tuple[list[str], np.ndarray] | DataFrame], penalty: float = PENALTY, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, mixture per row.

    ``mixture`` lists the selected languages with their proportions, the
    largest first. A null text, a text without a letter, and any text if no
    language was learned are ``und`` with score 0. Ties go to the language
    that sorts first. Rows are judged one by one, repeated ones alike; null
    ids stay null; other columns are ignored; an empty table gives no rows.
    A very long text is read whole and weighs at most BUCKETS numbers.

    With several blocks a language enters if it raises the penalised
    likelihood beside those selected from its own and earlier blocks, and the
    documents are written once for each block but the last.
    """
    state = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                        F.expr("cast(null as array<string>)").alias("names"), F.expr("cast(null as binary)").alias("logs"),
                        F.lit(None).cast("double").alias("rest"))
    for k, block in enumerate(blocks):
        last = k == len(blocks) - 1
        state = _meet(state, model_of(block) if isinstance(block, DataFrame) else block, penalty, last)
        if not last:
            state = written(state, "langid-block")
    return state


def _meet(state: DataFrame, block: tuple[list[str], np.ndarray], penalty: float, last: bool) -> DataFrame:
    """Select again among the languages selected before and those of a block.

    ``names`` and ``logs`` carry the selected languages with the log
    probabilities of the text's buckets; ``rest`` is the logarithm of the
    others' summed likelihoods (each to the power 1/3), for the score.
    """
    held = state.sparkSession.sparkContext.broadcast((block[0], block[1].astype(np.float32)))
    out = [("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("mixture", pa.string())] if last else \
        [("doc_id", pa.int64()), ("text", pa.string()), ("names", pa.list_(pa.string())), ("logs", pa.binary()), ("rest", pa.float64())]
    schema = pa.schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, model = held.value

        def rows():
            for doc_id, text, before, carried, rest in arrow_rows(batches):
                names = [*(before or ()), *own]
                if not names or not has_letter(text):
                    yield (doc_id, UNKNOWN, 0.0, "") if last else (doc_id, text, None, None, None)
                    continue
                at, n = grams(text)
                if not len(at):
                    yield (doc_id, min(names), 0.0, f"{min(names)}:0.000") if last else (doc_id, text, [min(names)], b"", None)
                    continue
                logs = model[:, at]
                if before:  # in the order of names, which decides ties
                    order = sorted(range(len(names)), key=names.__getitem__)
                    names = [names[i] for i in order]
                    logs = np.vstack([np.frombuffer(carried, np.float32).reshape(len(before), len(at)), logs])[order]
                chosen, share, alone = select(logs, n.astype(np.float64), penalty)
                if last:
                    top = sorted(zip(chosen, share, strict=True), key=lambda x: (-x[1], x[0]))
                    score = _score(share, alone, chosen[0])
                    if len(chosen) == 1 and rest is not None:
                        score = float(1 / (1 / score + np.exp(rest - alone[chosen[0]] / 3)))
                    yield doc_id, names[top[0][0]], score, " ".join(f"{names[k]}:{float(s):.3f}" for k, s in top)
                else:
                    others = np.delete(alone, chosen) / 3
                    parts = [*others, *([] if rest is None else [rest])]
                    yield doc_id, text, [names[k] for k in chosen], logs[chosen].tobytes(), float(np.logaddexp.reduce(parts)) if parts else None

        return arrow_out(schema, rows(), weight=lambda r: 0 if last else len(r[1] or "") + len(r[3] or b""))

    return state.mapInArrow(run, "doc_id long, lang_pred string, score double, mixture string" if last else
                            "doc_id long, text string, names array<string>, logs binary, rest double")


def fold(col: str = "doc_id", parts: int = 4):
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % parts


def identify(docs: DataFrame, held_out: int = 2, parts: int = 4, penalty: float = PENALTY) -> DataFrame:
    """Train on the documents outside the held-out fold, predict all.

    A null id belongs to no fold: it is not held out and teaches nothing.
    """
    blocks = train(docs.where(fold(parts=parts) != held_out))
    return predict(docs, blocks, penalty).withColumn("held_out", F.coalesce(fold(parts=parts) == held_out, F.lit(False)))
