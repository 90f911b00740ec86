"""Secret scans: exact base patterns and a character convolutional network over every further candidate.

The network sees the characters of a candidate and its surrounding context. It is trained here, in numpy, on labelled
findings of all rows and on generated ones: what the base patterns find and generated keys are positive (half of
them with a blank context, so that the network can't lean on the words before a secret), ordinary tokens and generated
names, addresses, numbers and paths are negative. Candidates that no base pattern covers are what the network is to judge;
they are not trained on. Its outputs are calibrated on a held-out fifth of the values (all rows of one value are on one
side), and the threshold is an even chance, or what keeps the recall asked for there among the table's findings and among the
generated ones, if that is lower.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmart.llm.common import steps, whole_groups
from textmart.session import cut_lineage

KINDS = ("assign", "access", "hex", "model")
ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
#: What the network looks at: runs of key characters, dots inside them included, that hold a letter and a digit, or upper and
#: lower case beyond the first, and are not shorter than LEAST.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=.-])[A-Za-z0-9+/_=-]+(?:\.[A-Za-z0-9+/_=-]+)*")
LEAST = 12
MIXED = re.compile(r"(?=.*[0-9])(?=.*[A-Za-z])|(?=.+[A-Z])(?=.+[a-z])", re.S)

BEFORE, BODY, AFTER = 24, 64, 8
WIDTH = BEFORE + BODY + AFTER
#: Codes: 0 nothing, 1 blank, 2 other, 3 other letter, then printable ASCII.
CODES = 4 + 94


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) by start, then kind."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Spans of further candidates; those that base spans cover whole are left out."""
    merged: list[list[int]] = []
    for b, _, f in base:
        if merged and b <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], f)
        else:
            merged.append([b, f])
    out, k = [], 0
    for m in CANDIDATE.finditer(text):
        s, e = m.span()
        if e - s < LEAST or not MIXED.match(m[0]):
            continue
        while k < len(merged) and merged[k][1] <= s:
            k += 1
        if not (k < len(merged) and merged[k][0] <= s and e <= merged[k][1]):
            out.append((s, e))
    return out


def code(chars: str) -> list[int]:
    return [4 + ord(c) - 33 if "!" <= c <= "~" else 1 if c.isspace() else 3 if c.isalpha() else 2 for c in chars]


def windows(text: str, start: int, end: int, context: bool = True) -> np.ndarray:
    """Codes of a candidate with its surroundings, a row for each BODY characters of it."""
    before = code(text[max(0, start - BEFORE):start]) if context else []
    after = code(text[end:end + AFTER]) if context else []
    rows = []
    for at in range(start, end, BODY):
        body = code(text[at:min(at + BODY, end)])
        rows.append([0] * (BEFORE - len(before)) + before + body + [0] * (BODY - len(body)) + after + [0] * (AFTER - len(after)))
    return np.array(rows, np.int64)


@dataclass
class CharCnn:
    """Embedding, one convolution, maximum and mean over positions, logistic output."""

    filters: int = 24
    size: int = 5
    dim: int = 8
    seed: int = 7
    weights: dict[str, np.ndarray] = field(default_factory=dict)
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 2.0

    def start(self) -> None:
        g = np.random.default_rng(self.seed)
        k = self.size * self.dim
        self.weights = {"E": g.normal(0, 0.5, (CODES, self.dim)), "W": g.normal(0, (2 / k) ** 0.5, (k, self.filters)),
                        "b": np.zeros(self.filters), "v": g.normal(0, 0.2, 2 * self.filters), "c": np.zeros(1)}
        self.weights = {k: v.astype(np.float32) for k, v in self.weights.items()}

    def forward(self, x: np.ndarray):
        w = self.weights
        cols = np.lib.stride_tricks.sliding_window_view(x, self.size, axis=1)  # n, positions, size
        e = w["E"][cols].reshape(*cols.shape[:2], -1)
        z = e @ w["W"] + w["b"]
        a = np.maximum(z, 0)
        top = a.argmax(axis=1)
        f = np.concatenate([np.take_along_axis(a, top[:, None, :], 1)[:, 0], a.mean(axis=1)], axis=1)
        return cols, e, z, top, f, f @ w["v"] + w["c"][0]

    def logits(self, x: np.ndarray, batch: int = 256) -> np.ndarray:
        return np.concatenate([self.forward(x[i:i + batch])[-1] for i in range(0, len(x), batch)]) if len(x) else np.empty(0)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.01, weight: np.ndarray | None = None) -> None:
        """From the weights there are, or anew where there are none."""
        if not self.weights:
            self.start()
        weight = np.ones(len(x)) if weight is None else weight
        g, t = np.random.default_rng(self.seed), 0
        moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.weights.items()}
        for _ in range(epochs):
            order = g.permutation(len(x))
            for at in range(0, len(x), batch):
                rows = order[at:at + batch]
                cols, e, z, top, f, out = self.forward(x[rows])
                n, positions = z.shape[:2]
                d = (1 / (1 + np.exp(-np.clip(out, -30, 30))) - y[rows]) * weight[rows] / n
                d = d.astype(np.float32)
                df = d[:, None] * self.weights["v"][None, :]
                dz = np.repeat(df[:, None, self.filters:] / positions, positions, axis=1)
                np.put_along_axis(dz, top[:, None, :], np.take_along_axis(dz, top[:, None, :], 1) + df[:, None, :self.filters], 1)
                dz *= z > 0
                flat = dz.reshape(-1, self.filters)
                de = (flat @ self.weights["W"].T).reshape(-1, self.dim)
                at_code = cols.reshape(-1)
                grad_e = np.stack([np.bincount(at_code, de[:, j], CODES) for j in range(self.dim)], axis=1)
                grads = {"E": grad_e, "W": e.reshape(-1, e.shape[-1]).T @ flat, "b": flat.sum(0), "v": f.T @ d, "c": d.sum(keepdims=True)}
                t += 1
                for k, grad in grads.items():
                    m, v = moment[k]
                    m += 0.1 * (grad - m)
                    v += 0.001 * (grad ** 2 - v)
                    self.weights[k] -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)

    def calibrate(self, x: np.ndarray, y: np.ndarray, recall: float, group: np.ndarray | None = None) -> None:
        """Platt scaling on held-out rows; an even chance as threshold, or less where that loses more than ``recall`` allows of
        the positives of a group."""
        self.calibrate_by(self.logits(x), y, np.ones(len(y)), recall, np.zeros(len(y), int) if group is None else group)

    def calibrate_by(self, s: np.ndarray, y: np.ndarray, n: np.ndarray, recall: float, group: np.ndarray) -> None:
        """``calibrate`` from logits, ``n`` rows of each; in a group, negatives weigh as much as twice its positives if they are more."""
        weight = n.astype(float)
        for g in np.unique(group):
            plain, key = (group == g) & (y == 0), (group == g) & (y == 1)
            weight[plain] *= min(1.0, 2 * max(n[key].sum(), 1) / max(n[plain].sum(), 1)) if n[key].sum() else 1.0
        weight /= weight.sum()
        a, b = 1.0, 0.0
        for _ in range(200):
            p = 1 / (1 + np.exp(-np.clip(a * s + b, -30, 30)))
            a, b = a - 0.1 * float(((p - y) * s * weight).sum()), b - 0.1 * float(((p - y) * weight).sum())
        self.scale, self.shift = max(a, 1e-3), b
        for g in np.unique(group[y == 1]):
            own = (y == 1) & (group == g)
            order = np.argsort(s[own])
            at = np.searchsorted(np.cumsum(n[own][order]), int((1 - recall) * n[own].sum()), side="right")
            self.threshold = min(self.threshold, 0.5, float(self.probability(s[own][order[at]])))

    def probability(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * logits + self.shift, -30, 30)))

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        """Calibrated probability of each candidate: the largest over its windows."""
        if not rows or not self.weights:
            return np.zeros(len(rows))
        p = self.probability(self.logits(np.concatenate(rows)))
        starts = np.cumsum([0, *(len(r) for r in rows[:-1])])
        return np.maximum.reduceat(p, starts)


#: Training rows of a part; times a single part, or each of many, is gone over; tokens that a task remembers; a value divisible
#: by HELD is held out.
PART_ROWS, ROUNDS, SEEN, HELD = 30_000, (6, 2), 300_000, 5
LABELLED = "label int, codes binary, value long"
#: Generated keys; there are twice as many generated tokens that are none.
GENERATED = 600
LETTERS, DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"


def generated(n: int = GENERATED, seed: int = 9) -> list[tuple[str, int]]:
    """``n`` keys (label 1) of several alphabets, lengths and prefixes, and ``2 * n`` tokens that only look long (label 0)."""
    rng = random.Random(seed)
    some = lambda alphabet, k: "".join(rng.choice(alphabet) for _ in range(k))
    syllables = [a + v + c for a in "bdfgklmnprst" for v in "aeiou" for c in ("", "n", "r", "s")]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 5)))
    mixed = LETTERS + LETTERS.upper() + DIGITS
    keys = [lambda: some(mixed, rng.randrange(16, 65)), lambda: some(mixed + "+/", rng.randrange(20, 60)) + rng.choice(["", "=", "=="]),
            lambda: some("0123456789abcdef", rng.randrange(16, 65)), lambda: some(LETTERS.upper() + DIGITS, rng.randrange(16, 40)),
            lambda: rng.choice(["sk_live", "pk", "ghp", "xoxb", "key", "sk-proj"]) + rng.choice("_-.") + some(mixed, rng.randrange(12, 48)),
            lambda: ".".join(some(mixed + "-_", rng.randrange(10, 40)) for _ in range(3)), lambda: some(LETTERS + DIGITS, rng.randrange(16, 50))]
    others = [lambda: "".join(word().title() for _ in range(3)), lambda: "_".join([word(), word(), str(rng.randrange(100))]),
              lambda: f"{word()}.{word().title()}", lambda: "/".join(["www." + word() + rng.choice([".org", ".com", ".net"]), word(), word() + str(rng.randrange(10 ** rng.randrange(1, 7)))]),
              lambda: f"{rng.randrange(1990, 2040)}-{rng.randrange(1, 13):02}-{rng.randrange(1, 29):02}T{rng.randrange(24):02}", lambda: word() + word() + str(rng.randrange(10_000)),
              lambda: "-".join(word() for _ in range(4)) + f"-{rng.randrange(100)}", lambda: f"{word()}/{word()}/{word()}.{rng.choice(['html', 'py', 'txt', 'jpg'])}{rng.randrange(10)}",
              lambda: word() + "..." + word().title(), lambda: f"{word()}={rng.randrange(100)}&{word()}", lambda: str(rng.randrange(10 ** 9)) + word().upper()]
    return [(rng.choice(keys)(), 1) for _ in range(n)] + [(rng.choice(others)(), 0) for _ in range(2 * n)]


def generated_rows(n: int = GENERATED, seed: int = 9) -> list[tuple[int, bytes, int]]:
    """(label, codes, value) of the generated tokens, each once among words and once with nothing around it."""
    rng, out = random.Random(seed + 1), []
    for token, y in generated(n, seed):
        before, after = rng.choice(["see ", "the ", "", "key is ", "(", "use "]), rng.choice([" and", ".", "", ", then", "\n"])
        for text, s in ((token, 0), (before + token + after, len(before))):
            out.append((y, windows(text, s, s + len(token))[0].astype(np.uint8).tobytes(), zlib.crc32(token.encode())))
    return out


def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, codes, value) of a text's base findings, each with its context and without, and of its ordinary tokens that are
    as long as a candidate has to be (the network judges no shorter ones).

    A token's value is a checksum of it; a token that a task met lately is not handed out again. Every other token stands
    with the context it has there, the others without, so that the network can't lean on the lack of a context.
    """
    word, seen = re.compile(r"[^\s]{%d,}" % LEAST), set()
    for _, texts in steps(batches):
        label, codes, value = [], [], []

        def add(t: str, s: int, e: int, y: int, context: bool, own: int, label=label, codes=codes, value=value) -> None:
            label.append(y)
            codes.append(windows(t, s, e, context=context)[0].astype(np.uint8).tobytes())
            value.append(own)

        for t in texts:
            base = base_spans(t or "")
            for s, _, e in base:
                if t[s:s + 4] != "AKIA" and not HEX.fullmatch(t[s:e]):
                    s = ASSIGN.match(t, s).start(2)
                own = zlib.crc32(t[s:e].encode("utf-8", "replace"))
                add(t, s, e, 1, True, own)
                add(t, s, e, 1, False, own)
            for m in word.finditer(t or ""):
                if (token := m[0]) in seen:
                    continue
                s, e = m.span()
                if any(s < f and b < e for b, _, f in base):
                    continue
                seen.add(token)
                if not candidates(token, []):  # candidates are not labelled: they are left for the network to judge
                    own = zlib.crc32(token.encode("utf-8", "replace"))
                    add(t, s, e, 0, own % 2 == 0, own)
        if len(seen) > SEEN:
            seen.clear()
        yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(codes, pa.binary()), pa.array(value, pa.int64())],
                                         names=["label", "codes", "value"])


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sample_rows: int | None = None, recall: float = 0.98) -> CharCnn:
    """Fit the network on every base finding and every distinct ordinary token of all rows, and on generated tokens of both
    kinds, so that tables of any size, also empty ones, have the same method. ``sample_rows`` bounds the rows that ordinary
    tokens are taken from; without it none is left out.

    Training rows are dealt to parts of about PART_ROWS; in each round a task goes over a part and the generated rows from the
    common weights, and the parts' weights are averaged. A table of one part is gone over ROUNDS[0] times, one of many
    ROUNDS[1] times. Scaling and threshold come from all held-out rows, by counts of their logits to two decimals.
    """
    rows = docs.select(F.col(id_col), F.col(text_col))
    if sample_rows is not None and (n := rows.count()) > sample_rows:
        drawn = F.pmod(F.xxhash64(F.lit(11), id_col), F.lit(1_000_000)) < F.lit(int(1_000_000 * sample_rows / n))
        found = rows.mapInArrow(labelled, LABELLED).where("label = 1").union(rows.where(drawn).mapInArrow(labelled, LABELLED).where("label = 0"))
    else:
        found = rows.mapInArrow(labelled, LABELLED)
    # a finding once for each context, a token once
    token = F.when(F.col("label") == 0, F.col("value"))
    found = found.groupBy("label", "value", F.when(token.isNull(), F.col("codes")).alias("finding")).agg(F.min("codes").alias("codes"))
    found = cut_lineage(found.select("label", "codes", "value"))
    learned, held = found.where(f"value % {HELD} <> 0"), found.where(f"value % {HELD} = 0")
    parts = max(1, -(-learned.count() // PART_ROWS))
    dealt = learned.withColumn("part", F.pmod(F.xxhash64(F.lit(13), "value"), F.lit(parts)).cast("int"))
    dealt = dealt.repartition(parts, "part").sortWithinPartitions("part", "value", "label", "codes")
    dealt = cut_lineage(dealt)
    cnn = CharCnn()
    cnn.start()

    def round_of(part: int, codes: pa.ChunkedArray, labels: pa.ChunkedArray, weights: dict[str, np.ndarray]) -> pa.RecordBatch:
        made = [r for r in generated_rows() if r[2] % HELD]
        x = np.stack([np.frombuffer(c, np.uint8) for c in [*codes.to_pylist(), *(r[1] for r in made)]]).astype(np.int64)
        y = np.array([*labels.to_pylist(), *(r[0] for r in made)], float)
        keys = max(1, len(y) - int((y == 0).sum()))
        own = CharCnn(weights={k: v.copy() for k, v in weights.items()}, seed=7 + part)
        # findings are rarer than words
        own.fit(x, y, epochs=1 if parts > 1 else ROUNDS[0], weight=np.where(y == 1, np.clip(0.5 * (y == 0).sum() / keys, 1, 10), 1.0))
        return pa.RecordBatch.from_arrays([pa.array([part]), pa.array([len(codes)]), pa.array([flat(own.weights).tolist()], pa.list_(pa.float64()))],
                                          names=["part", "n", "weights"])

    for _ in range(ROUNDS[1] if parts > 1 else 1):
        weights = cnn.weights

        def step(batches: Iterator[pa.RecordBatch], weights=weights) -> Iterator[pa.RecordBatch]:
            for t in whole_groups(batches, ["part"], PART_ROWS):
                at = t.column("part").to_numpy()
                for part in np.unique(at):
                    own = t.filter(pa.array(at == part))
                    yield round_of(int(part), own.column("codes"), own.column("label"), weights)

        got = dealt.select("part", "codes", "label").mapInArrow(step, "part long, n long, weights array<double>").collect()
        got.sort(key=lambda r: r["part"])  # here: a sort by Spark would train twice, once to find its ranges
        if not got:
            nothing = pa.chunked_array([[]], pa.binary()), pa.chunked_array([[]], pa.int32())
            got = round_of(0, *nothing, weights).to_pylist()
        share = np.array([max(r["n"], 1) for r in got], float)
        cnn.weights = unflat(share / share.sum() @ np.array([r["weights"] for r in got]), weights)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                some = batch.slice(at, 4096)
                x = np.stack([np.frombuffer(c, np.uint8) for c in some.column(1).to_pylist()]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(np.round(cnn.logits(x).astype(float), 2) + 0.0)], names=["label", "logit"])

    logits = held.select("label", "codes").mapInArrow(scored, "label int, logit double").groupBy("label", "logit").agg(F.count("*").alias("n")).collect()
    made = [r for r in generated_rows() if r[2] % HELD == 0]
    own = cnn.logits(np.stack([np.frombuffer(r[1], np.uint8) for r in made]).astype(np.int64))
    every = sorted((0, r["label"], r["logit"], r["n"]) for r in logits) + [(1, r[0], s, 1) for r, s in zip(made, own.tolist(), strict=True)]
    group, y, s, n = (np.array(c) for c in zip(*every, strict=True))
    cnn.calibrate_by(s.astype(float), y, n, recall, group)
    return cnn


def flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in sorted(weights)])


def unflat(values: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    names = sorted(like)
    cuts = np.cumsum([like[k].size for k in names])[:-1]
    return {k: v.reshape(like[k].shape).copy() for k, v in zip(names, np.split(values.astype(np.float32), cuts), strict=True)}


SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


def find_secrets(docs: DataFrame, cnn: CharCnn, *, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """``(<id_col>, spans)`` for every row; spans (kind, start, end, score) by start, then kind, in code points, end exclusive.

    Base findings (kinds assign, access, hex) are exact and always stay; kind model holds the network's. A null text
    counts as empty; repeated rows give repeated rows; a candidate of any length is scored over its whole length. With
    ``keep_text`` a column ``text`` holds the text with each (merged) span replaced by ``[SECRET]``, null for null.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    narrow = docs.select(F.col(id_col), F.col(text_col))
    id_type, kind = to_arrow_type(narrow.schema[0].dataType), narrow.dtypes[0][1]
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
    text_name = "redacted_text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in steps(batches):
            found, rows, where = [], [], []
            for k, t in enumerate(texts):
                base = base_spans(t or "")
                found.append([(s, y, e, 1.0) for s, y, e in base])
                for s, e in candidates(t, base) if t else ():
                    rows.append(windows(t, s, e))
                    where.append((k, s, e))
            for (k, s, e), p in zip(where, cnn.scores(rows), strict=True):
                if p >= cnn.threshold:
                    found[k].append((s, 3, e, float(p)))
            spans = [[{"kind": KINDS[y], "start": s, "end": e, "score": p} for s, y, e, p in sorted(f)] for f in found]
            arrays = [pa.array(ids, id_type), pa.array(spans, span_type)]
            if keep_text:
                arrays.append(pa.array([redacted(t, f) for t, f in zip(texts, found, strict=True)], pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, names=[id_col, "spans", *([text_name] if keep_text else [])])

    return narrow.mapInArrow(run, f"`{id_col}` {kind}, spans {SPANS}" + (f", {text_name} string" if keep_text else ""))


def redacted(text: str | None, spans: list[tuple]) -> str | None:
    if not spans or text is None:
        return text
    out, at, upto = [], 0, -1
    for s, _, e, _ in sorted(spans):
        if s >= upto:
            out += [text[at:s], "[SECRET]"] if upto < 0 or s > upto else []
        upto = max(upto, e)
        at = upto
    return "".join(out) + text[at:]


def span_text(spans: Column, *, base_only: bool) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    kept = F.filter(spans, lambda x: x["kind"] != "model") if base_only else spans
    return F.array_join(F.transform(kept, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
