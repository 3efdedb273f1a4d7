"""Personal data: fixed patterns first, then a linear-chain conditional random field.

The patterns give the base spans of four kinds. The field is trained on a small table of
labelled token sequences and tags tokens by their word shapes; its spans are added where
they touch no base span and every token of theirs is sure.

- *Sequences.* Personal data holds a digit or an ``@``. A sequence is a run of tokens round
  such tokens, ``CONTEXT`` tokens to either side; all other tokens are outside by definition,
  so whole texts are judged but plain prose costs one scan.
- *Training.* Sequences (of up to ``TRAIN_TOKENS`` tokens) of at most ``TRAIN_DOCS``
  documents, chosen by a hash of their text, labelled by the base patterns and counted, the
  ``TRAIN_EXAMPLES`` most frequent ones; each phone number is given again without its country code,
  so that the field learns digits and signs rather than the leading plus. Gradient steps on
  the log-likelihood, with forward and backward sums in numpy over padded batches.
- *Decoding.* Viterbi in numpy over padded batches of sequences, bounded by their padded size,
  so that one long sequence pads no others; a text of numbers alone costs a few hundred bytes
  a token while it is decoded.

Defined results: a null or empty text has no spans; repeated rows are judged each for
itself; an empty table gives an empty result; without any labelled sequence nothing is
added; other columns, whatever their names, pass through ``redact`` unchanged (but
``n_chars``, which is counted again).
"""

from __future__ import annotations

import re
from ast import literal_eval
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertalk.llm.common import with_fields

# Kinds in the order in which they are listed.
KINDS = ("email", "ip", "card", "phone")
TRAIN_DOCS, TRAIN_TOKENS, TRAIN_EXAMPLES = 2000, 24, 800
CONTEXT = 2
STEPS, RATE, PENALTY = 120, 0.4, 1e-3
# Least probability of every token's tag in an added span.
SURE = 0.95
BATCH = 512
# Tokens of a padded batch, unless one run is longer, and tokens whose features are held at once.
CELLS, PART = 16_384, 2_048

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
# A failed run of digits cannot succeed from its middle, so runs are tried from their start.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
MARKS = re.compile(r"[0-9@]")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")

Span = tuple[int, int, str]
# A text's number and the offsets of its tokens.
Run = tuple[int, list[tuple[int, int]]]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[Span]:
    """Each match holds one ``@``: its local part reaches as far left as it can, but not
    into the match before."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end(), "email"
            done = found.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str | None) -> list[Span]:
    """Spans of the patterns by start, then kind; leftmost and not overlapping in a kind."""
    if not text or not MARKS.search(text):
        return []
    found = list(emails(text))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split(".")):
            found.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), "card"))
    for m in PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def written(spans: Sequence[Span]) -> str:
    ordered = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in ordered)


# Sequences and their features.

SHAPE_LOWER, SHAPE_UPPER = re.compile(r"[a-z]+"), re.compile(r"[A-Z]+")
SHAPE_DIGITS = re.compile(r"[0-9]+")


def shape(token: str) -> str:
    """Letters as ``a`` and ``A``, runs as one; digits as ``9`` with the run's length."""
    token = SHAPE_LOWER.sub("a", SHAPE_UPPER.sub("A", token))
    token = SHAPE_DIGITS.sub(lambda m: f"9{min(len(m[0]), 20)}", token)
    return "".join(c if c.isascii() else "u" for c in token)[:40]


def features(tokens: Sequence[str]) -> list[list[str]]:
    """Features of each token, from its own shape and its neighbours' kinds of characters."""
    kinds = ["d" if SHAPE_DIGITS.search(t) else "@" if "@" in t else "w" for t in tokens]
    found = []
    for i, token in enumerate(tokens):
        digits = len(_digits(token))
        bare = token.strip(".,;:!?()[]\"'")
        found.append(
            [
                "bias",
                f"shape={shape(bare)}",
                f"digits={min(digits, 20)}",
                f"signs={''.join(sorted({c for c in bare if not c.isalnum()}))[:6]}",
                f"letters={any(c.isalpha() for c in bare)}",
                f"before={kinds[i - 1] if i else 'edge'}",
                f"after={kinds[i + 1] if i + 1 < len(kinds) else 'edge'}",
                f"first={token[:1] if not token[:1].isalnum() else kinds[i]}",
            ]
        )
    return found


def sequences(text: str | None) -> list[list[tuple[int, int]]]:
    """Runs of tokens, as offsets, round the tokens that hold a digit or an ``@``."""
    if not text or not MARKS.search(text):
        return []
    runs: list[list[tuple[int, int]]] = []
    recent: list[tuple[int, int]] = []
    owed = 0
    for m in TOKEN.finditer(text):
        here = m.span()
        if MARKS.search(m[0]):
            if owed == 0:
                runs.append([])
            runs[-1] += [*recent, here]
            recent, owed = [], 2 * CONTEXT + 1
        elif owed > 0:
            recent.append(here)
            owed -= 1
            if owed == 0:
                runs[-1] += recent[:CONTEXT]
                recent = recent[-CONTEXT:]
        else:
            recent = [*recent, here][-CONTEXT:]
    if owed and recent:
        runs[-1] += recent[:CONTEXT]
    return runs


LABELS = ("O", *(f"{part}-{kind}" for kind in KINDS for part in "BI"))


def labelled(text: str, run: Sequence[tuple[int, int]], spans: Sequence[Span]) -> list[int]:
    """Label numbers of a run's tokens: a token that a span covers in part belongs to it."""
    found = []
    last: Span | None = None
    for start, end in run:
        hit = next((s for s in spans if s[0] < end and start < s[1]), None)
        if hit is None:
            found.append(0)
        else:
            found.append(LABELS.index(f"{'I' if hit == last else 'B'}-{hit[2]}"))
        last = hit
    return found


@dataclass
class Field:
    """Weights of a trained field."""

    index: dict[str, int]
    emit: np.ndarray
    move: np.ndarray
    start: np.ndarray

    def scores(self, rows: Sequence[list[list[str]]]) -> tuple[np.ndarray, np.ndarray]:
        """Emission scores, padded, and the true lengths."""
        lengths = np.array([len(r) for r in rows])
        out = np.zeros((len(rows), int(lengths.max(initial=1)), len(LABELS)))
        for i, row in enumerate(rows):
            for j, names in enumerate(row):
                ids = [self.index[n] for n in names if n in self.index]
                out[i, j] = self.emit[ids].sum(axis=0)
        return out, lengths

    def viterbi(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Best labels of a padded batch; steps beyond a row's length repeat its end."""
        n, width, _ = scores.shape
        best = self.start + scores[:, 0]
        back = np.zeros(scores.shape, dtype=np.int8)
        for t in range(1, width):
            paths = best[:, :, None] + self.move[None]
            back[:, t] = paths.argmax(axis=1)
            step = paths.max(axis=1) + scores[:, t]
            best = np.where((t < lengths)[:, None], step, best)
        labels = np.zeros((n, width), dtype=np.int64)
        rows = np.arange(n)
        now = best.argmax(axis=1)
        for t in range(width - 1, -1, -1):
            labels[:, t] = np.where(t < lengths, now, 0)
            before = back[rows, t, now]
            now = np.where((t < lengths) & (t > 0), before, now)
        return labels

    def marginals(self, scores: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log forward and backward sums and the log of each row's total."""
        n, width, k = scores.shape
        ahead = np.zeros((n, width, k))
        behind = np.zeros((n, width, k))
        ahead[:, 0] = self.start + scores[:, 0]
        for t in range(1, width):
            step = _logsum(ahead[:, t - 1][:, :, None] + self.move[None], 1) + scores[:, t]
            ahead[:, t] = np.where((t < lengths)[:, None], step, ahead[:, t - 1])
        for t in range(width - 2, -1, -1):
            step = _logsum(
                self.move[None] + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], 2
            )
            behind[:, t] = np.where((t + 1 < lengths)[:, None], step, 0.0)
        return ahead, behind, _logsum(ahead[:, -1], 1)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def train(examples: Sequence[tuple[list[list[str]], list[int]]], times: Sequence[int] | None = None) -> Field:
    """Fit by AdaGrad steps on the penalised log-likelihood, examples counted ``times``; the
    same examples give the same field."""
    names = sorted({n for row, _ in examples for token in row for n in token})
    k = len(LABELS)
    field = Field(
        {n: i for i, n in enumerate(names)},
        np.zeros((len(names), k)),
        np.zeros((k, k)),
        np.zeros(k),
    )
    if not examples:
        return field
    weight = np.ones(len(examples)) if times is None else np.asarray(times, dtype=float)
    order = sorted(range(len(examples)), key=lambda i: (len(examples[i][0]), *examples[i][::-1]))
    examples, weight = [examples[i] for i in order], weight[order]
    lengths = np.array([len(r) for r, _ in examples])
    n, width, whole_weight = len(examples), int(lengths.max()), weight.sum()
    rows, cols, ids = [], [], []
    gold = np.zeros((n, width, k))
    for i, (row, labels) in enumerate(examples):
        for j, (token, label) in enumerate(zip(row, labels, strict=True)):
            gold[i, j, label] = weight[i]
            for name in token:
                rows.append(i)
                cols.append(j)
                ids.append(field.index[name])
    rows_, cols_, ids_ = np.array(rows), np.array(cols), np.array(ids)
    real = np.arange(width)[None] < lengths[:, None]
    weights = [field.emit, field.move, field.start]
    seen = [np.full(w.shape, 1e-8) for w in weights]
    moved = np.einsum("ntj,ntk->jk", gold[:, :-1] / weight[:, None, None], gold[:, 1:])
    for _ in range(STEPS):
        scores = np.zeros((n, width, k))
        np.add.at(scores, (rows_, cols_), field.emit[ids_])
        ahead, behind, whole = field.marginals(scores, lengths)
        each = np.exp(ahead + behind - whole[:, None, None])
        each *= real[:, :, None] * weight[:, None, None]
        emit = np.zeros_like(field.emit)
        np.add.at(emit, ids_, (gold - each)[rows_, cols_])
        pairs = np.zeros((k, k))
        for t in range(width - 1):
            use = real[:, t + 1]
            logs = (
                ahead[use, t][:, :, None]
                + field.move[None]
                + (scores[use, t + 1] + behind[use, t + 1])[:, None, :]
                - whole[use][:, None, None]
            )
            pairs += np.einsum("njk,n->jk", np.exp(logs), weight[use])
        grads = [emit, moved - pairs, (gold[:, 0] - each[:, 0]).sum(axis=0)]
        for w, g, s in zip(weights, grads, seen, strict=True):
            g = g / whole_weight - PENALTY * w
            s += g * g
            w += RATE * g / np.sqrt(s)
    return field


def _in_batches(runs: list[Run]) -> Iterator[list[Run]]:
    """Runs by length, in batches that are no larger than ``CELLS`` when padded; a longer run
    is one by itself."""
    batch: list[Run] = []
    for run in sorted(runs, key=lambda r: len(r[1])):
        if batch and (len(batch) == BATCH or (len(batch) + 1) * len(run[1]) > CELLS):
            yield batch
            batch = []
        batch.append(run)
    if batch:
        yield batch


def _emissions(texts: Sequence[str | None], batch: list[Run], field: Field) -> tuple[np.ndarray, np.ndarray]:
    """Padded scores of the runs and their lengths. Features, which are much larger than their
    scores, are those of a part of a run at a time, with the neighbour at either side."""
    lengths = np.array([len(run) for _, run in batch])
    out = np.zeros((len(batch), int(lengths.max()), len(LABELS)))
    for r, (i, run) in enumerate(batch):
        for a in range(0, len(run), PART):
            b = min(a + PART, len(run))
            low, high = max(a - 1, 0), min(b + 1, len(run))
            rows = features([texts[i][x:y] for x, y in run[low:high]])[a - low : b - low]
            out[r, a:b] = field.scores([rows])[0][0]
    return out, lengths


def _covered(bases: list[Span]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that spans cover, none touching the next."""
    starts: list[int] = []
    ends: list[int] = []
    for start, end, _ in sorted(bases):
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def added_spans(texts: Sequence[str | None], bases: Sequence[list[Span]], field: Field) -> list[list[Span]]:
    """Sure spans of the field that touch no base span, for each text."""
    found: list[list[Span]] = [[] for _ in texts]
    if not field.index:
        return found
    runs = [(i, run) for i, text in enumerate(texts) for run in sequences(text)]
    covered = {i: _covered(bases[i]) for i in {i for i, _ in runs}}
    for batch in _in_batches(runs):
        scores, lengths = _emissions(texts, batch, field)
        labels = field.viterbi(scores, lengths)
        if not labels.any():
            continue
        ahead, behind, whole = field.marginals(scores, lengths)
        for r, (i, run) in enumerate(batch):
            starts, ends = covered[i]
            for first, last, kind in _tagged(labels[r][: len(run)]):
                at = np.arange(first, last)
                logs = (ahead[r, at] + behind[r, at])[at - first, labels[r, at]] - whole[r]
                span = _trimmed(texts[i], run[first][0], run[last - 1][1])
                before = bisect_left(starts, span[1]) - 1
                if (
                    np.exp(logs).min() >= SURE
                    and _plausible(texts[i][span[0] : span[1]], kind)
                    and not (before >= 0 and ends[before] > span[0])
                ):
                    found[i].append((*span, kind))
    # By length of run they came; by place they leave.
    return [sorted(spans) for spans in found]


def _tagged(labels: Sequence[int]) -> Iterator[tuple[int, int, str]]:
    t = 0
    while t < len(labels):
        if labels[t] == 0:
            t += 1
            continue
        kind, first = LABELS[labels[t]][2:], t
        t += 1
        while t < len(labels) and labels[t] and LABELS[labels[t]] == f"I-{kind}":
            t += 1
        yield first, t, kind


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    while start < end and text[start] in "\"'<[{,;:":
        start += 1
    while end > start and text[end - 1] in "\"'>]},;:.!?":
        end -= 1
    return start, end


def _plausible(text: str, kind: str) -> bool:
    digits = len(_digits(text))
    if kind == "email":
        return "@" in text
    if kind == "ip":
        return digits >= 4 and text.count(".") == 3
    if any(c.isalpha() for c in text):
        return False
    return digits >= (13 if kind == "card" else 9)


def examples_of(text: str) -> list[tuple[list[list[str]], list[int]]]:
    """Labelled sequences of a text, and those with a phone's country code taken away."""
    found = []
    spans = base_spans(text)
    for run in sequences(text):
        if len(run) > TRAIN_TOKENS:
            continue
        labels = labelled(text, run, spans)
        tokens = [text[a:b] for a, b in run]
        found.append((features(tokens), labels))
        if "B-phone" in (LABELS[x] for x in labels):
            cut, cut_labels = [], []
            for token, label in zip(tokens, labels, strict=True):
                if label and LABELS[label].endswith("phone") and token.startswith("+"):
                    continue
                first = LABELS[label] == "I-phone" and (not cut_labels or cut_labels[-1] == 0)
                cut.append(token)
                cut_labels.append(LABELS.index("B-phone") if first else label)
            if cut:
                found.append((features(cut), cut_labels))
    return found


def fit(docs: DataFrame, text_column: str = "text", train_docs: int = TRAIN_DOCS) -> Field:
    """Train on documents chosen by a hash of their text, at most ``train_docs``."""
    marked = docs.select(F.col(text_column).alias("text")).filter(F.col("text").rlike("[0-9@]"))
    chosen = marked.select(
        F.xxhash64("text", F.lit(3)).alias("key"), F.crc32(F.col("text").cast("binary")).alias("tie")
    ).distinct().orderBy("key", "tie").limit(train_docs)
    # Few digits, so few sequences: only the tokens round them leave the executors.

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [repr(e) for t in batch.column("text").to_pylist() for e in examples_of(t)]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.string())], ["example"])

    keyed = marked.withColumn("key", F.xxhash64("text", F.lit(3)))
    found = (
        keyed.join(F.broadcast(chosen.select("key")), "key", "left_semi")
        .select("text")
        .mapInArrow(rows, "example string")
        .groupBy("example")
        .count()
        .orderBy(F.desc("count"), F.xxhash64("example"), "example")
        .limit(TRAIN_EXAMPLES)
        .collect()
    )
    return train([literal_eval(r["example"]) for r in found], [r["count"] for r in found])


def in_parts(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def spans(docs: DataFrame, field: Field, text_column: str = "text") -> DataFrame:
    """``doc_id, base, added``: arrays of ``start, end, kind`` in code points."""
    kind = "array<struct<start: int, end: int, kind: string>>"
    schema = with_fields(docs.select("doc_id").schema, f"base {kind}, added {kind}")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = pa.list_(
            pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])
        )

        def listed(each: list[list[Span]]) -> pa.Array:
            return pa.array(
                [[{"start": a, "end": b, "kind": k} for a, b, k in found] for found in each], of
            )

        for batch in in_parts(batches):
            texts = batch.column("text").to_pylist()
            bases = [base_spans(t) for t in texts]
            more = added_spans(texts, bases, field)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), listed(bases), listed(more)], ["doc_id", "base", "added"]
            )

    return docs.select("doc_id", F.col(text_column).alias("text")).mapInArrow(find, schema)


def masked(text: str | None, found: Sequence[Span]) -> str | None:
    """The text with each span, or chain of overlapping spans, replaced by its first kind."""
    if text is None or not found:
        return text
    parts, at, until = [], 0, -1
    for start, end, kind in sorted(found, key=lambda s: (s[0], KINDS.index(s[2]))):
        if start >= until:
            parts += [text[at:start], f"[{kind.upper()}]"]
        until = max(until, end)
        at = until
    return "".join(parts) + text[at:]


def redact(docs: DataFrame, field: Field) -> DataFrame:
    """The documents with personal data in ``text`` replaced; ``n_chars`` follows the text."""
    columns = docs.columns
    text_at = columns.index("text")

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            texts = batch.column(text_at).to_pylist()
            bases = [base_spans(t) for t in texts]
            more = added_spans(texts, bases, field)
            new = [masked(t, [*b, *m]) for t, b, m in zip(texts, bases, more, strict=True)]
            arrays = list(batch.columns)
            arrays[text_at] = pa.array(new, batch.schema.field(text_at).type)
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    found = docs.mapInArrow(replace, docs.schema)
    if "n_chars" in columns:
        found = found.withColumn(
            "n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)
        )
    return found
