"""Language identification by interpolated Kneser-Ney character models.

One model of order four per language over lower-case letters (everything else is one blank). N-grams are packed exactly
into 64-bit keys held in sorted arrays, with the finished log-probabilities of all languages beside each key, so a look-up
is one binary search. The language with the lowest length-normalised cross-entropy is chosen; a text whose cross-entropy
lies beyond nearly all held-out texts of its language (wider for short texts) is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmart.llm.common import steps
from textmart.session import cut_lineage

ORDER = 4
DISCOUNT = 0.75
#: Parts of the labelled rows: a text is calibrated by a model of the other parts. N-grams that a task holds before it adds them up.
PARTS, HELD_GRAMS = 5, 4_000_000
#: Slack of the rejection limit, nats a character, and the number of standard errors that a short text may be off.
SLACK, ERRORS = 0.5, 3.0
#: Quantile of the calibration texts at the limit, absolute deviations beyond which a text is noise, fewest texts to calibrate with.
QUANTILE, FAR, CALIBRATION = 0.995, 6.0, 20
#: Characters scored at once.
CHUNK = 1 << 16


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Code point to lower-case letter in 16 bits, 0 for anything else."""
    out = np.zeros(0x110000, np.uint16)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            out[i] = min(ord(c.lower()[0]), 0xFFFF)
    return out


def symbols(text: str | None) -> np.ndarray:
    """Letters with one blank (0) before, between and after words; empty if there is no letter."""
    codes = letters()[np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)]
    if not codes.any():
        return np.empty(0, np.uint64)
    codes = np.concatenate(([0], codes, [0]))
    return codes[(codes != 0) | np.r_[True, codes[:-1] != 0]].astype(np.uint64)


def grams(seq: np.ndarray) -> np.ndarray:
    """Packed n-grams of order ORDER, one for each symbol after the first; blanks stand before the text."""
    s = np.concatenate((np.zeros(ORDER - 2, np.uint64), seq))
    n = len(s) - ORDER + 1
    key = np.zeros(max(n, 0), np.uint64)
    for k in range(ORDER):
        key = (key << np.uint64(16)) | s[k:k + n]
    return key


@dataclass
class KneserNey:
    """Sorted key arrays with log-probabilities (rows: keys, columns: languages) of each order."""

    langs: list[str]
    keys: dict[int, np.ndarray] = field(default_factory=dict)
    logp: dict[int, np.ndarray] = field(default_factory=dict)
    contexts: dict[int, np.ndarray] = field(default_factory=dict)
    backoff: dict[int, np.ndarray] = field(default_factory=dict)
    floor: float = 0.0
    #: Rejection limit a + b / sqrt(letters), nats a character; a for each language.
    limit: tuple[float | np.ndarray, float] = (np.inf, 0.0)

    @classmethod
    def fit(cls, langs: list[str], lang: np.ndarray, key: np.ndarray, count: np.ndarray) -> KneserNey:
        """lang (index), key, count: n-gram counts of order ORDER."""
        self = cls(langs)
        by: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {ORDER: []}
        for x in range(len(langs)):
            own = lang == x
            order = np.argsort(key[own])
            by[ORDER].append((key[own][order], count[own][order].astype(float)))
        for n in range(ORDER - 1, 0, -1):  # below the top: how many different symbols come before
            mask = np.uint64((1 << (16 * n)) - 1)
            by[n] = [tuple(map(np.asarray, np.unique(k & mask, return_counts=True))) for k, _ in by[n + 1]]
        symbols_seen = np.unique(np.concatenate([k for k, _ in by[1]]) if langs else np.empty(0, np.uint64))
        self.floor = -float(np.log(len(symbols_seen) + 1))
        for n in range(1, ORDER + 1):
            self.keys[n] = np.unique(np.concatenate([k for k, _ in by[n]]))
            self.contexts[n] = np.unique(self.keys[n] >> np.uint64(16))
            self.logp[n] = np.zeros((len(self.keys[n]), len(langs)), np.float32)
            self.backoff[n] = np.zeros((len(self.contexts[n]), len(langs)), np.float32)
            lower = self.score(self.keys[n] & np.uint64((1 << (16 * (n - 1))) - 1), n - 1)
            ctx_of = np.searchsorted(self.contexts[n], self.keys[n] >> np.uint64(16))
            for x, (k, c) in enumerate(by[n]):
                at = np.searchsorted(self.keys[n], k)
                total = np.bincount(ctx_of[at], c, len(self.contexts[n]))
                types = np.bincount(ctx_of[at], minlength=len(self.contexts[n]))
                with np.errstate(divide="ignore", invalid="ignore"):
                    lam = np.where(total > 0, DISCOUNT * types / total, 1.0)
                p = lam[ctx_of] * np.exp(lower[:, x])
                p[at] += np.maximum(c - DISCOUNT, 0) / total[ctx_of[at]]
                self.logp[n][:, x] = np.log(p)
                self.backoff[n][:, x] = np.log(lam)
        return self

    def score(self, key: np.ndarray, n: int = ORDER) -> np.ndarray:
        """Log-probability of the last symbol of each key given the others, for every language."""
        if n == 0:
            return np.full((len(key), len(self.langs)), self.floor, np.float32)
        table = self.keys[n]
        at = np.minimum(np.searchsorted(table, key), len(table) - 1)
        hit = table[at] == key
        out = self.logp[n][at]
        if not hit.all():
            miss = key[~hit]
            rest = self.score(miss & np.uint64((1 << (16 * (n - 1))) - 1), n - 1)
            ctx = miss >> np.uint64(16)
            c = np.minimum(np.searchsorted(self.contexts[n], ctx), len(self.contexts[n]) - 1)
            out[~hit] = rest + np.where((self.contexts[n][c] == ctx)[:, None], self.backoff[n][c], 0)
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cross-entropy in nats a symbol (rows: texts, columns: languages), symbols, and the sums of squares for the best."""
        n, total = np.zeros(len(texts), np.int64), np.zeros((len(texts), len(self.langs)))
        keys = []
        for k, t in enumerate(texts):
            seq = symbols(t)
            if len(seq) > 1:
                keys.append(grams(seq))
                n[k] = len(keys[-1])
        if keys and self.langs:
            key, owner = np.concatenate(keys), np.repeat(np.arange(len(texts)), n)
            for at in range(0, len(key), CHUNK):
                who = owner[at:at + CHUNK]
                starts = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
                total[who[starts]] += np.add.reduceat(self.score(key[at:at + CHUNK]).astype(np.float64), starts, axis=0)
        return -total / np.maximum(n, 1)[:, None], n, total

    def limit_by(self, best: np.ndarray, lang: np.ndarray, n: np.ndarray) -> None:
        """Set the rejection limit of each language from held-out labelled texts, of which a part may be noise or mislabelled.

        Given are their lowest cross-entropies, the languages of those and the numbers of symbols.

        Texts far beyond the median (in absolute deviations) are set aside; the limit is a high quantile of the others,
        with slack. A language that few of the texts are in gets the limit of all languages together.
        """
        best, lang, n = best[n > 0], lang[n > 0], n[n > 0]
        if not len(n):
            return
        wide = ERRORS * 2.0  # a symbol's surprise has a deviation of about two nats

        def limit(own: np.ndarray) -> float:
            low, middle = best[own] - wide / np.sqrt(n[own]), float(np.median(best[own]))
            off = 1.4826 * float(np.median(np.abs(best[own] - middle)))
            near = low[low <= middle + max(SLACK, FAR * off)]
            return max(float(np.quantile(near, QUANTILE)) if len(near) else middle, middle) + SLACK

        every = np.ones(len(best), bool)
        counts = np.bincount(lang, minlength=len(self.langs))
        self.limit = (np.array([limit(lang == x if c >= CALIBRATION else every) for x, c in enumerate(counts)]), wide)

    def limit_over(self, rows: DataFrame) -> None:
        """``limit_by`` for a table (best, lang, n) of any size; cross-entropies are taken to four decimals, so that the quantiles
        of a language, which are exact, need no more than one counter for each value."""
        wide = ERRORS * 2.0
        both = rows.select(F.explode(F.array(F.col("lang"), F.lit(-1))).alias("lang"), F.round("best", 4).alias("best"),
                           F.round(F.col("best") - wide / F.sqrt("n"), 4).alias("low"))
        middle = {r.lang: (r.middle, r.n) for r in both.groupBy("lang").agg(F.percentile("best", 0.5).alias("middle"), F.count("*").alias("n")).collect()}
        if not middle:
            return
        by = lambda d: F.create_map(*(F.lit(x) for k, v in d.items() for x in (k, v)))[F.col("lang")]
        off = F.percentile(F.round(F.abs(F.col("best") - by({k: m for k, (m, _) in middle.items()})), 4), 0.5)
        far = {r.lang: middle[r.lang][0] + max(SLACK, FAR * 1.4826 * r.off) for r in both.groupBy("lang").agg(off.alias("off")).collect()}
        near = both.filter(F.col("low") <= by(far)).groupBy("lang").agg(F.percentile("low", QUANTILE).alias("limit"))
        high = {r.lang: r.limit for r in near.collect()}
        limit = {k: max(high.get(k, m), m) + SLACK for k, (m, _) in middle.items()}
        self.limit = (np.array([limit[x if x in middle and middle[x][1] >= CALIBRATION else -1] for x in range(len(self.langs))]), wide)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Language or und, score, cross-entropy, symbols, rejected."""
        h, n, _ = self.entropies(texts)
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts)), n, n == 0
        best = h.argmin(axis=1)  # ties: the first in the order of the names
        low = h[np.arange(len(h)), best]
        score = 1 / np.exp((low[:, None] - h) * np.minimum(n, 30)[:, None]).sum(axis=1)
        a, b = self.limit
        rejected = (n == 0) | (low > np.broadcast_to(a, len(self.langs))[best] + b / np.sqrt(np.maximum(n, 1)))
        lang = [self.langs[x] if k else "und" for x, k in zip(best, n, strict=True)]
        return lang, np.where(n > 0, score, 0.0), np.where(n > 0, low, 0.0), n, rejected


def held_out(doc_id: Column) -> Column:
    """Documents that are not learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> KneserNey:
    """Fit on all rows that are not held out (whole texts); null languages are left out.

    Every row is counted, and every row calibrates the rejection limits: its text is scored by the model of the other parts
    (``PARTS`` parts by a hash of the id), whose counts are the total less those of its own part. The driver gets the
    summed n-gram counts, which are the model, and a few quantiles. A table with fewer than ``PARTS * CALIBRATION`` texts is
    calibrated on the driver (``cross_calibrate``); one with a single text has no limit.
    """
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(id_col).alias("id"),
                       F.pmod(F.xxhash64(F.lit(6), id_col), F.lit(PARTS)).cast("int").alias("part"))
    rows = rows.filter(~held_out(F.col("id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counted = rows.withColumn("group", F.concat_ws(":", F.col("part").cast("string"), "lang")).select("group", "text")
    counted = counted.mapInArrow(gram_counts, "group string, k long, n long").groupBy("group", "k").agg(F.sum("n").alias("n"))
    got = counted.withColumn("part", F.substring_index("group", ":", 1).cast("int")).withColumn("lang", F.expr("substr(group, 3)")).select("part", "lang", "k", "n").toArrow()
    if not got.num_rows:
        return KneserNey([])
    names, part = got.column("lang").combine_chunks().dictionary_encode(), got.column("part").to_numpy()
    seen = names.dictionary.to_pylist()
    langs = sorted(seen)
    lang = np.array([langs.index(x) for x in seen])[names.indices.to_numpy()]
    key, n = got.column("k").to_numpy().view(np.uint64), got.column("n").to_numpy()
    model = KneserNey.fit(langs, *summed(lang, key, n))
    if (size := rows.count()) < PARTS * CALIBRATION:
        if size:
            cross_calibrate(model, [(r.lang, r.text) for r in rows.select("lang", "text").orderBy(F.xxhash64("id"), "text", "lang").collect()])
        return model
    others = [KneserNey.fit(langs, *summed(lang[part != k], key[part != k], n[part != k])) for k in range(PARTS)]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts, texts in steps(batches):
            parts = np.array(parts)
            for k in np.unique(parts):
                h, size, _ = others[k].entropies([t for t, x in zip(texts, parts, strict=True) if x == k])
                yield pa.RecordBatch.from_arrays([pa.array(h.min(axis=1)), pa.array(h.argmin(axis=1)), pa.array(size)], names=["best", "lang", "n"])

    model.limit_over(cut_lineage(rows.select("part", "text").mapInArrow(scored, "best double, lang long, n long").filter("n > 0")))
    return model


def gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(group, n-gram, count) of (group, text) rows, added up in a task before they leave it."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    fresh: dict[str, list[np.ndarray]] = {}
    size = 0

    def fold() -> int:
        for x, found in fresh.items():
            held.setdefault(x, []).append(np.unique(np.concatenate(found), return_counts=True))
        fresh.clear()
        for x, parts in held.items():
            _, k, n = summed(np.zeros(1), np.concatenate([k for k, _ in parts]), np.concatenate([n for _, n in parts]))
            held[x] = [(k, n)]
        return sum(len(k) for ((k, _),) in held.values())

    def out() -> Iterator[pa.RecordBatch]:
        for x, ((k, n),) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([x] * len(k), pa.string()), pa.array(k.view(np.int64)), pa.array(n)], names=["group", "k", "n"])
        held.clear()

    for groups, texts in steps(batches):
        for x, t in zip(groups, texts, strict=True):
            if len(s := symbols(t)) > 1:
                fresh.setdefault(x, []).append(grams(s))
                size += len(s)
        if size > HELD_GRAMS:
            size = 0
            if fold() > HELD_GRAMS:
                yield from out()
    fold()
    yield from out()


def summed(lang: np.ndarray, key: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts added up by language and key."""
    if len(lang) < len(key):
        lang = np.broadcast_to(lang, len(key))
    order = np.lexsort((key, lang))
    lang, key, count = lang[order], key[order], count[order]
    first = np.flatnonzero(np.r_[True, (lang[1:] != lang[:-1]) | (key[1:] != key[:-1])][:len(key)])
    return lang[first], key[first], np.add.reduceat(count, first) if len(first) else count


def cross_calibrate(model: KneserNey, rows: list[tuple[str, str]], parts: int = 5) -> None:
    """Rejection limits from few (language, text) rows: every text is scored by a model of the other parts."""
    best, lang, size = [], [], []
    for k in range(parts):
        learned = [(x, grams(s)) for i, (x, t) in enumerate(rows) if i % parts != k and len(s := symbols(t)) > 1]
        names = sorted({x for x, _ in learned})
        asked = [t for i, (_, t) in enumerate(rows) if i % parts == k]
        if not names or not asked:
            continue
        owner, key, times = [], [], []
        for j, x in enumerate(names):
            found, n = np.unique(np.concatenate([g for y, g in learned if y == x]), return_counts=True)
            owner.append(np.full(len(found), j))
            key.append(found)
            times.append(n)
        h, n, _ = KneserNey.fit(names, np.concatenate(owner), np.concatenate(key), np.concatenate(times)).entropies(asked)
        best.append(h.min(axis=1))
        lang.append(np.array([model.langs.index(names[j]) if names[j] in model.langs else 0 for j in h.argmin(axis=1)], np.int64))
        size.append(n)
    if best:
        model.limit_by(np.concatenate(best), np.concatenate(lang), np.concatenate(size))


def identify(docs: DataFrame, model: KneserNey, *, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """``(<id_col>, lang_pred, score, cross_entropy, n_symbols, rejected)`` for every row, and ``text`` with ``keep_text``.

    ``lang_pred`` is a learned language, ``und`` (score 0, rejected) for a null text or one without a letter, and ``und``
    throughout if nothing was learned (then only texts without a letter are rejected). Ties go to the first language by
    name. Whole texts of any length are scored; repeated rows give repeated rows; other columns are not read.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    narrow = docs.select(F.col(id_col), F.col(text_col))
    id_type, kind = to_arrow_type(narrow.schema[0].dataType), narrow.dtypes[0][1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in steps(batches):
            lang, score, h, n, rejected = model.predict(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type), pa.array(lang), pa.array(score), pa.array(h), pa.array(n), pa.array(rejected), *([pa.array(texts, pa.string())] if keep_text else [])],
                names=[id_col, "lang_pred", "score", "cross_entropy", "n_symbols", "rejected", *(["text"] if keep_text else [])])

    return narrow.mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double, cross_entropy double, n_symbols long, rejected boolean"
                             + ", text string" * keep_text)
