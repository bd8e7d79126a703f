"""Problem 10: private data in running text, found by a linear-chain conditional random field and replaced by type.

The field is trained on the small labelled table of `labelled` with features of word shape, word and neighbourhood. A
text is cut into tokens (an address of a mailbox or a group of digits is one), lines are decoded whole; every distinct
token's scores are computed once per worker, so a line is scored by adding rows, and Viterbi runs over whole batches
of sequences in numpy. An exact check of each decoded item follows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import spread, table
from .labelled import labelled_sentences
from .names import NICKNAMES, fold

LABELS = ["O", "name", "+name", "email", "phone", "id_number", "+id_number", "address", "+address"]
KINDS = ["email", "phone", "id_number", "address", "name"]
#: Fillings of every template of the labelled table, rounds of training, step, and weight of the prior.
COPIES, ROUNDS, STEP, PRIOR = 28, 8, 0.05, 1e-4
#: Characters decoded in one batch.
BATCH_CHARS = 400_000

_AT = r"(?:\s?(?:@|＠|&#64;|[(\[{<]\s?at\s?[)\]}>])\s?|\s+AT\s+|\s+at\s+(?=[\w-]+(?:\s+dot\s|\s?[(\[{]\s?(?:dot|\.)\s?[)\]}])))"
_DOT = r"(?:\.|\s?[(\[{]\s?(?:dot|\.)\s?[)\]}]\s?|\s+(?:dot|DOT)\s+)"
EMAIL = rf"(?<![\w.+%-])\w[\w.+%-]*(?<![.-]){_AT}[^\W_][\w-]*(?:{_DOT}[^\W_][\w-]*)+"
#: Groups of digits; every group is checked where it ends, so that no long run is read twice.
_NUMBER = r"\+?\(?\d++\)?(?![\w:])(?:[  ./-]\(?\d++\)?(?![\w:]))*+"
_URL, _WORD = r"(?:https?://|www\.)[^\s<>\"]+", r"[^\W\d_]+(?:[’'-][^\W\d_]+)*"
_REST = rf"(?<!\w)@\w+|\d{{4}}-\d\d-\d\d(?!\d)|\d{{1,2}}:\d\d(?::\d\d)?(?!\d)|{_NUMBER}|(?=[^\W\d]*+\d)\w++(?:-(?=[^\W\d]*+\d)\w++)*+|{_WORD}|[^\w\s]|_+|\w"
TOKENS = re.compile(rf"{_URL}|(?P<e>{EMAIL})|{_REST}")
#: The same tokens, faster: for lines that can hold no mail address, most of which are words.
PLAIN_TOKENS = re.compile(rf"{_URL}|[^\W\d_]++(?![\d_])(?:[’'-][^\W\d_]+)*|{_REST}")
MAY_HOLD_MAIL = re.compile(r"@|＠|&#64;|[(\[{<]\s?at\s?[)\]}>]|\sAT\s|\sat\s+(?=[\w-]+(?:\s+dot\s|\s?[(\[{]\s?(?:dot|\.)\s?[)\]}]))")


def tokens_in(line: str) -> Iterator[re.Match]:
    return (TOKENS if MAY_HOLD_MAIL.search(line) else PLAIN_TOKENS).finditer(line)


_GIVEN = set(NICKNAMES) | {s for v in NICKNAMES.values() for s in v.split()}
#: Words of streets, and of institutions and laws.
STREET_WORDS = set("st street rd road ave avenue ln lane dr drive blvd boulevard way terrace court ct place rue calle c avenida plaza straße strasse weg allee platz tor gasse chemin quai paseo".split())
ORG_WORDS = set("county university act arena institute college school center centre foundation lake precinct bill department association".split())


@cache
def features_of(token: str) -> tuple[str, ...]:
    """What a token looks like; the model sees nothing else of it."""
    first = token[0]
    if token.startswith(("http://", "https://", "www.")):
        return ("k=url",)
    if len(token) > 3 and re.fullmatch(EMAIL, token):
        return ("k=email",)
    if first.isdigit() or first in "+(" and len(token) > 1:
        shape = re.sub(r"\d", "9", token)
        n = sum(c.isdigit() for c in token)
        kind = "k=number" if re.fullmatch(r"[\d+()\s./:-]+", token) else "k=code"
        return (kind, f"n={shape}" if kind == "k=number" else f"n={re.sub(r'[^\W\d]', 'x', shape)}", f"d={min(n, 12)}", f"d0={token.lstrip('+(')[:1]}" if n > 6 else "d0=")
    if any(c.isdigit() for c in token):
        shape = re.sub(r"\d", "9", re.sub(r"[^\W\d_]", "x", token))
        return ("k=code", f"n={shape}", f"d={min(sum(c.isdigit() for c in token), 12)}")
    if not first.isalpha():
        return ("k=mark", f"w={token}")
    low = token.lower()
    case = "u" if len(token) == 1 and token.isupper() else "U" if token.isupper() else "c" if first.isupper() else "l"
    plain = fold(low)
    hyphen = "" if "-" not in token else "-C" if re.search(r"-[^\W\d_a-z]", token) else "-"
    out = [f"c={case}", f"w={low}", f"c={case}{hyphen}{min(len(token), 4)}"]
    if len(low) > 3 and case in "cl":
        out += ["own" if low.endswith(("’s", "'s")) else f"e={low[-3:]}"]
    if plain in _GIVEN:
        out += [f"given={case}"]
    if low in STREET_WORDS or low.endswith(("straße", "weg", "allee", "strasse", "platz")):
        out += ["street"]
    if low in ORG_WORDS:
        out += ["org"]
    return tuple(out)


class Field:
    """Weights: by place in the window, feature and label; by pair of labels; by first label."""

    def __init__(self, names: dict[str, int], weights: np.ndarray, moves: np.ndarray, starts: np.ndarray):
        self.names, self.weights, self.moves, self.starts = names, weights, moves, starts
        self._reset()

    def __getstate__(self):
        return self.names, self.weights, self.moves, self.starts

    def __setstate__(self, state):
        self.__init__(*state)

    def _reset(self) -> None:
        self.rows: dict[str, int] = {}
        self.scores = np.zeros((1024, 5, len(LABELS)), np.float32)

    def row(self, token: str) -> int:
        at = self.rows.get(token)
        if at is None:
            at = self.rows[token] = len(self.rows) + 1  # row 0 is outside of the sequence
            if at >= len(self.scores):
                self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
            known = [i for f in features_of(token) if (i := self.names.get(f)) is not None]
            self.scores[at] = self.weights[:, known].sum(axis=1)
        return at

    def decode(self, sequences: list[list[int]]) -> list[np.ndarray]:
        """The best labels of each sequence of rows, batched by length."""
        order = sorted(range(len(sequences)), key=lambda k: len(sequences[k]))
        out: list[np.ndarray] = [np.zeros(0, np.int8)] * len(sequences)
        at = 0
        while at < len(order):
            size = len(sequences[order[at]])
            stop = at
            while stop < len(order) and len(sequences[order[stop]]) <= max(size + 4, int(size * 1.15)) and (stop - at) * size < 60_000:
                stop += 1
            group = [sequences[k] for k in order[at:stop]]
            for k, labels in zip(order[at:stop], self._viterbi(group), strict=True):
                out[k] = labels
            at = stop
        return out

    def _emissions(self, rows: np.ndarray) -> np.ndarray:
        wide = np.pad(rows, ((0, 0), (2, 2)))
        n = rows.shape[1]
        return sum(self.scores[wide[:, o : o + n], o] for o in range(5))

    def _viterbi(self, group: list[list[int]]) -> Iterator[np.ndarray]:
        sizes = np.array([len(g) for g in group])
        longest = sizes.max()
        rows = np.zeros((len(group), longest), np.int64)
        for k, g in enumerate(group):
            rows[k, : len(g)] = g
        emitted = self._emissions(rows)
        best = emitted[:, 0] + self.starts
        back = np.zeros((len(group), longest, len(LABELS)), np.int8)
        keep = np.arange(len(LABELS), dtype=np.int8)
        for t in range(1, longest):
            options = best[:, :, None] + self.moves
            prior = options.argmax(axis=1)
            new = np.take_along_axis(options, prior[:, None, :], 1)[:, 0] + emitted[:, t]
            live = (t < sizes)[:, None]
            best = np.where(live, new, best)
            back[:, t] = np.where(live, prior, keep)
        label = best.argmax(axis=1)
        path = np.zeros((len(group), longest), np.int8)
        for t in range(longest - 1, -1, -1):
            path[:, t] = label
            label = np.take_along_axis(back[:, t], label[:, None], 1)[:, 0]
        return (p[:n] for p, n in zip(path, sizes, strict=True))


def _labelled(text: str, marks: list[tuple[int, int, str]]) -> tuple[list[str], list[int]]:
    tokens, labels = [], []
    for m in tokens_in(text):
        tokens.append(m.group())
        kind = next((x for x in marks if x[0] <= m.start() < x[1]), None)
        if kind is None:
            labels.append(0)
        else:
            inner = kind[0] < m.start() and labels[-1] in (LABELS.index(kind[2]), LABELS.index("+" + kind[2]) if "+" + kind[2] in LABELS else -1)
            labels.append(LABELS.index("+" + kind[2]) if inner and "+" + kind[2] in LABELS else 0 if inner else LABELS.index(kind[2]))
    return tokens, labels


def _allowed() -> np.ndarray:
    moves = np.zeros((len(LABELS), len(LABELS)), np.float32)
    for j, b in enumerate(LABELS):
        if b[0] == "+":
            for i, a in enumerate(LABELS):
                if a not in (b, b[1:]):
                    moves[i, j] = -1e4
    return moves


@cache
def trained(copies: int = COPIES, rounds: int = ROUNDS, seed: int = 7) -> Field:
    """The field, fitted to the labelled table by maximum likelihood (forward-backward, Adam).

    The table has `copies` fillings of each template, whatever the size of the corpus.
    """
    data = [d for text, marks in labelled_sentences(copies, seed) if (d := _labelled(text, marks))[0]]
    counts: dict[str, int] = {}
    for tokens, _ in data:
        for t in tokens:
            for f in features_of(t):
                counts[f] = counts.get(f, 0) + 1
    names = {f: k for k, f in enumerate(sorted(f for f, n in counts.items() if n > 2))}
    n_labels = len(LABELS)
    known = {t: np.array([names[f] for f in features_of(t) if f in names], np.int64) for tokens, _ in data for t in tokens}
    weights, moves, starts = np.zeros((5, len(names), n_labels)), np.zeros((n_labels, n_labels)), np.zeros(n_labels)
    banned = _allowed().astype(float)
    first = np.array([-1e4 if x[0] == "+" else 0 for x in LABELS])
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (weights, moves, starts)]
    rng, step = np.random.default_rng(seed), 0
    order = sorted(range(len(data)), key=lambda k: len(data[k][0]))
    batches = [order[i : i + 64] for i in range(0, len(order), 64)]
    for _ in range(rounds):
        for b in rng.permutation(len(batches)):
            step += 1
            grads = _gradient([data[k] for k in batches[b]], known, weights, moves + banned, starts + first)
            for p, g, s in zip((weights, moves, starts), grads, state, strict=True):
                g += PRIOR * p
                s[0] = 0.9 * s[0] + 0.1 * g
                s[1] = 0.99 * s[1] + 0.01 * g * g
                p -= STEP * (s[0] / (1 - 0.9**step)) / (np.sqrt(s[1] / (1 - 0.99**step)) + 1e-8)
    return Field(names, weights.astype(np.float32), (moves + banned).astype(np.float32), (starts + first).astype(np.float32))


def _gradient(group, known, weights, moves, starts):
    """Of the mean negative log likelihood of a batch of labelled sequences."""
    n, longest, k = len(group), max(len(t) for t, _ in group), len(LABELS)
    sizes = np.array([len(t) for t, _ in group])
    emitted = np.zeros((n, longest, k))
    spots: list[list[np.ndarray]] = [[], [], []]  # feature, sequence, position, for each offset alike
    for i, (tokens, _) in enumerate(group):
        for t, token in enumerate(tokens):
            f = known[token]
            spots[0].append(f)
            spots[1].append(np.full(len(f), i))
            spots[2].append(np.full(len(f), t))
    f, s, t = (np.concatenate(x) for x in spots)
    for o in range(5):
        at = t + 2 - o  # the position that sees this token at offset o - 2
        ok = (at >= 0) & (at < sizes[s])
        np.add.at(emitted, (s[ok], at[ok]), weights[o, f[ok]])
    live = np.arange(longest)[None] < sizes[:, None]
    forward = np.zeros((n, longest, k))
    forward[:, 0] = emitted[:, 0] + starts
    for x in range(1, longest):
        a = forward[:, x - 1, :, None] + moves
        top = a.max(axis=1, keepdims=True)
        forward[:, x] = np.where(live[:, x, None], np.log(np.exp(a - top).sum(axis=1)) + top[:, 0] + emitted[:, x], forward[:, x - 1])
    top = forward[:, -1].max(axis=1, keepdims=True)
    total = np.log(np.exp(forward[:, -1] - top).sum(axis=1)) + top[:, 0]
    backward = np.zeros((n, longest, k))
    pairs = np.zeros((k, k))
    for x in range(longest - 2, -1, -1):
        a = moves + (emitted[:, x + 1] + backward[:, x + 1])[:, None, :]
        top = a.max(axis=2, keepdims=True)
        on = live[:, x + 1, None]
        backward[:, x] = np.where(on, np.log(np.exp(a - top).sum(axis=2)) + top[..., 0], 0)
        joint = np.exp(np.minimum(forward[:, x, :, None] + a - total[:, None, None], 0))
        pairs += joint[live[:, x + 1]].sum(axis=0)
    share = np.exp(np.minimum(forward + backward - total[:, None, None], 0)) * live[..., None]
    begun = share[:, 0].sum(axis=0)
    for i, (_, labels) in enumerate(group):
        share[i, np.arange(len(labels)), labels] -= 1
        begun[labels[0]] -= 1
        np.subtract.at(pairs, (labels[:-1], labels[1:]), 1)
    grad = np.zeros_like(weights)
    for o in range(5):
        at = t + 2 - o
        ok = (at >= 0) & (at < sizes[s])
        np.add.at(grad[o], f[ok], share[s[ok], at[ok]])
    return grad / n, pairs / n, begun / n


def find_private(texts: list[str | None], field: Field) -> list[list[tuple[int, int, str]]]:
    """[(start, end, kind)] of each text, in order; none for null and empty texts. Offsets count code points."""
    if len(field.rows) > 300_000:
        field._reset()
    lines, sequences = [], []  # (text, offset of the line, line)
    for k, text in enumerate(texts):
        offset = 0
        for line in re.split(r"(?<=[\n\r \x0b\x0c])", text or ""):
            tokens = [m.group() for m in tokens_in(line)] if line.strip() else []
            if tokens:
                lines.append((k, offset, line))
                sequences.append(list(map(field.row, tokens)))
            offset += len(line)
    found: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    for (k, offset, line), labels in zip(lines, field.decode(sequences), strict=True):
        if not labels.any():
            continue
        spans = [m.span() for m in tokens_in(line)]
        t = 0
        while t < len(labels):
            if labels[t] == 0:
                t += 1
                continue
            stop = t + 1
            kind = LABELS[labels[t]].lstrip("+")
            while stop < len(labels) and LABELS[labels[stop]] == "+" + kind:
                stop += 1
            start, end = spans[t][0], spans[stop - 1][1]
            for a, b in _checked(line, start, end, kind):
                last = found[k][-1] if found[k] else (0, -9, "")
                if kind == last[2] == "address" and not text_between(line, last[1] - offset, a).strip(" ,"):
                    found[k][-1] = (last[0], offset + b, kind)  # the parts of one address
                else:
                    found[k].append((offset + a, offset + b, kind))
            t = stop
    return found


_NAME = re.compile(r"[^\W\d_]+(?:[’'-][^\W\d_]+)*\.?(?:(?:,? |, ?)[^\W\d_]+(?:[’'-][^\W\d_]+)*\.?)+")


def text_between(line: str, start: int, end: int) -> str:
    """What stands between two places of a line; a letter where the first lies before the line."""
    return line[start:end] if start >= 0 else "x"


def _checked(line: str, start: int, end: int, kind: str) -> list[tuple[int, int]]:
    """Exact check of a decoded item: the parts of it that can be of this kind."""
    text = line[start:end]
    digits = sum(c.isdigit() for c in text)
    # Digits amid a longer run of digits and dots are no numbers of anybody.
    loose = not (line[max(0, start - 2) : start].endswith("..") or re.match(r"\.\.|\.\d|\d", line[end : end + 2]) or re.search(r"[\w]\.$", line[max(0, start - 2) : start]))
    good = {
        "email": lambda: re.fullmatch(EMAIL, text),
        "phone": lambda: loose and 7 <= digits <= 15 and not re.search(r"[^\W\d_]", text),
        "id_number": lambda: loose and 6 <= digits <= 14,
        "address": lambda: digits and text[0].isalnum() and not re.match(r"(?:Suite|Unit|Apt)\b", text) and re.search(r"[A-ZÀ-Þ0-9][\w.]* ?.*[^\W\d_]{2}", text) and any(w[0].isupper() or w in STREET_WORDS for w in re.findall(r"[^\W\d_]+", text)),
        "name": lambda: True,
    }[kind]()
    if not good:
        return []
    return [(start + a, start + b) for a, b in _names_in(text)] if kind == "name" else [(start, end)]


def _is_given(word: str) -> bool:
    return fold(word) in _GIVEN or bool(re.fullmatch(r"[^\W\d_]\.", word))


def _names_in(text: str) -> list[tuple[int, int]]:
    """The names in a run of words that was decoded as one: each has two words or more, one of them longer than two letters, and
    the first is no possessive.

    Two names side by side part where the second's given name begins, if that is a known one or an initial.
    """
    words = [(m.group(), m.start(), m.end()) for m in re.finditer(r"[^\W\d_]+(?:[’'-][^\W\d_]+)*\.?|,", text)]
    out, at = [], 0
    while at < len(words):
        stop, full = at + 1, 0
        turned = at + 1 < len(words) and words[at + 1][0] == ","
        while stop < len(words):
            w = words[stop][0]
            if turned and stop - at >= 3 and not re.fullmatch(r"[^\W\d_]\.", w):
                break
            if not turned and (w == "," or stop - at >= 2 and _is_given(w) and not (len(w) == 2 and stop - at == 1) and len(words[stop - 1][0]) > 2):
                break
            stop += 1
        name = words[at:stop]
        full = [w for w, _, _ in name if w != ","]
        if len(full) > 1 and not re.search(r"[’']s$", full[0]) and max(map(len, full)) > 2 and _NAME.fullmatch(text[name[0][1] : name[-1][2]]):
            out.append((name[0][1], name[-1][2]))
        at = stop
    return out


def _in_batches(texts: list[str | None], field: Field) -> Iterator[tuple[int, list[list[tuple[int, int, str]]]]]:
    """(first text, items of each) of runs of texts of about BATCH_CHARS characters together."""
    start, chars = 0, 0
    for k, x in enumerate(texts):
        chars += len(x or "")
        if chars > BATCH_CHARS or k + 1 == len(texts):
            yield start, find_private(texts[start : k + 1], field)
            start, chars = k + 1, 0


def private_items(df: DataFrame, key: str, text: str, field: Field | None = None) -> DataFrame:
    """(`key`, kind, start_at, length) of every item of private data; one row per occurrence.

    Null, empty and blank texts have none; whole texts are read, of whatever length; repeated rows give their items each.
    """
    shared = df.sparkSession.sparkContext.broadcast(field or trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0)
            for start, found in _in_batches(batch.column(1).to_pylist(), shared.value):
                rows = [(start + i, kind, a, b - a) for i, items in enumerate(found) for a, b, kind in items]
                at, kinds, starts, sizes = zip(*rows, strict=True) if rows else ((), (), (), ())
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(at, pa.int64())), pa.array(kinds, pa.string()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())], [batch.schema.names[0], "kind", "start_at", "length"])

    kind = df.schema[key].dataType.simpleString()
    return spread(df.select(key, text)).mapInArrow(run, f"`{key}` {kind}, kind string, start_at bigint, length bigint")


def _replaced(text: str | None, items: list[tuple[int, int, str]]) -> str | None:
    if not items:
        return text
    parts, at = [], 0
    for a, b, kind in items:
        parts += [text[at:a], f"[{kind}]"]
        at = b
    return "".join(parts) + text[at:]


def redacted(df: DataFrame, key: str, text: str, field: Field | None = None) -> DataFrame:
    """(`key`, `text`) with every item replaced by its type in brackets, such as [email]; the rest is unchanged.

    A null text stays null.
    """
    shared = df.sparkSession.sparkContext.broadcast(field or trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, found in _in_batches(texts, shared.value):
                plain = [_replaced(texts[start + i], items) for i, items in enumerate(found)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(found)), pa.array(plain, pa.string())], batch.schema.names)

    kind = df.schema[key].dataType.simpleString()
    return spread(df.select(key, text)).mapInArrow(run, f"`{key}` {kind}, `{text}` string")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every item of private data in documents."""
    return private_items(table(spark, sf_dir, "documents"), "doc_id", "text").select("doc_id", "kind", "start_at")


def p10_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents with private data replaced."""
    return redacted(table(spark, sf_dir, "documents"), "doc_id", "text")


SQL: dict[str, str] = {}
QUERIES = {"p10_found": p10_found, "p10_redacted": p10_redacted}
