"""Personal data: exact patterns, and a linear-chain conditional random field for the forms they miss.

Base spans are the leftmost matches of four fixed patterns (e-mail, IP address, payment card, phone) that pass a check of their
own.  A conditional random field labels the tokens of every line (runs of letters, runs of digits, single marks) from the shapes of
the word and its neighbours, and its spans are added where they touch no base span: ``name (at) host dot tld``, ``10[.]0[.]0[.]1``,
cards grouped by dots, phones without a plus sign.  As base spans do, spans of the field pass a check of their kind (:func:`well_formed`).

The field is trained from a small labelled table (text, spans).  :func:`labelled_windows` makes one from a bounded part of
the documents (``TRAIN_DOCUMENTS`` by hash of the text, then about ``TRAIN_WINDOWS`` windows of every kind): windows around base spans,
labelled by them, and windows without any.  Every span is also learned in rewritten forms, and in spoilt forms (a wrong check
digit, a part above 255) that are labelled as nothing.  The fitted weights have a fixed size and are broadcast.

Decoding is Viterbi over batches of lines in numpy.  A line is cut into blocks of ``BLOCK`` tokens which are solved side by side for
every label before them, and joined exactly, so a line of any length gets the path that plain Viterbi gives.  Texts are read
in pieces of whole lines of about ``PIECE`` characters: memory follows the longest line, not the text.

Defined cases: null and empty texts have no spans; overlapping base spans of different kinds all stay; added spans of equal place
cannot occur; positions are code points, the end exclusive; without labelled rows nothing is added; rows that repeat an id or text
get equal spans; an empty table gives no rows; other columns stay, but for one named ``pii``.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import slices
from varloom.operators.materialize import stored

KINDS = ("email", "ip", "card", "phone")
LABELS = ("", *KINDS)
#: Documents that windows are cut from, windows learned of every kind, and characters on either side of a span.
TRAIN_DOCUMENTS, TRAIN_WINDOWS, MARGIN = 20_000, 300, 60
BLOCK, PIECE = 64, 1 << 19
Span = tuple[str, int, int]

# The four patterns of the contract.  Runs that fail are taken whole (possessively), which finds the same matches in linear time.
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]++(@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)?")
_IP = re.compile(r"[0-9]++((?:\.[0-9]++){3})?")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NUMBER = re.compile(r"[0-9](?:[\x20./_-]?[0-9]){11,}")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    """Whether the check digit of a digit string is right."""
    doubled = sum(int(d) * 2 - 9 * (d > "4") for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[-1::-2]))) % 10 == 0


def _small(part: str) -> bool:
    bare = part.lstrip("0")
    return len(bare) <= 3 and int(bare or "0") <= 255


def base_spans(text: str | None) -> list[Span]:
    """Spans of the fixed patterns, by kind and then start."""
    found: list[Span] = []
    if not text:
        return found
    if "@" in text:
        found += [("email", *m.span()) for m in _EMAIL.finditer(text) if m[1]]
    if _DIGIT.search(text):
        found += [("ip", *m.span()) for m in _IP.finditer(text) if m[1] and all(map(_small, m[0].split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = _NOT_DIGIT.sub("", m[0])
                if 16 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", *m.span()))
        if "+" in text:
            found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return found


# ---------------------------------------------------------------- tokens and features

_SPACE, _NUM, _LETTER, _MARK, _LINE = range(5)
_KIND = np.full(129, _MARK, dtype=np.uint8)
_KIND[:33] = _SPACE
_KIND[10] = _LINE
_KIND[127] = _SPACE
_KIND[48:58] = _NUM
_KIND[65:91] = _KIND[97:123] = _KIND[128] = _LETTER
#: Number of shapes; the last one stands for the edge of a line.
SHAPES, EDGE = 256, 255
_WORDS, _BIGRAMS = 1 << 11, 1 << 13
#: Sizes of the feature blocks in the order in which :meth:`Tokens.features` gives them.
SIZES = (SHAPES, 2 * SHAPES, 2 * SHAPES, SHAPES, SHAPES, _BIGRAMS, _BIGRAMS, _WORDS, _WORDS, _WORDS, 64)
_STARTS = np.cumsum((0, *SIZES))[:-1]
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _numbers(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, end, feature) of groups of 12 and more digits: how many there are, and whether the check digit is right."""
    if _DIGIT.search(text):
        for m in _NUMBER.finditer(text):
            digits = _NOT_DIGIT.sub("", m[0])
            yield m.start(), m.end(), 2 * min(len(digits), 30) + (len(digits) <= 19 and luhn(digits))


@dataclass
class Tokens:
    """Tokens of several texts: places in the joined text, line by line."""

    starts: np.ndarray
    ends: np.ndarray
    #: first token of every line that has any, in order
    lines: np.ndarray
    #: features x tokens, numbered over all blocks
    features: np.ndarray
    #: where every text begins in the joined text
    texts: np.ndarray


def tokenise(texts: list[str]) -> Tokens:
    joined = "\n".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    text_starts = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    kinds = _KIND[np.minimum(codes, 128)]
    if not len(kinds):
        none = np.zeros(0, dtype=np.int64)
        return Tokens(none, none, none, np.zeros((len(SIZES), 0), dtype=np.int64), text_starts)
    fresh = np.ones(len(kinds), dtype=bool)
    fresh[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == _MARK)
    starts = np.flatnonzero(fresh)
    ends = np.append(starts[1:], len(kinds))
    kind = kinds[starts]
    breaks = np.cumsum(kind == _LINE)
    real = (kind == _NUM) | (kind == _LETTER) | (kind == _MARK)
    starts, ends, kind, line = starts[real], ends[real], kind[real], breaks[real]
    n = len(starts)
    first = np.ones(n, dtype=bool)
    first[1:] = line[1:] != line[:-1]
    length = ends - starts

    def inside(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return sums[ends] - sums[starts]

    head = np.minimum(codes[starts], 128)
    shape = np.full(n, EDGE - 1, dtype=np.int64)
    if n:
        upper = inside((codes >= 65) & (codes <= 90))
        other = inside(codes >= 128)
        first_upper = (head >= 65) & (head <= 90)
        case = np.where(other > 0, 4, np.where(upper == 0, 0, np.where(upper == length, 2, np.where((upper == 1) & first_upper, 1, 3))))
        size = np.searchsorted(np.array([2, 3, 4, 5, 7, 10]), length, side="right")
        shape = np.where(kind == _LETTER, 50 + case * 7 + size, shape)
        value = np.zeros(n, dtype=np.int64)
        for at in range(3):
            digit = codes[np.minimum(starts + at, len(codes) - 1)].astype(np.int64) - 48
            value = np.where(at < length, value * 10 + digit, value)
        shape = np.where(kind == _NUM, np.where((length == 3) & (value > 255), 0, np.minimum(length, 40)), shape)
        shape = np.where(kind == _MARK, 90 + head.astype(np.int64), shape)
    packed = np.zeros(n, dtype=np.uint64)
    for at in range(8):
        code = codes[np.minimum(starts + at, max(len(codes) - 1, 0))].astype(np.uint64) & np.uint64(0xFF)
        code = np.where((code >= 65) & (code <= 90), code + np.uint64(32), code)
        packed = np.where(at < length, packed * np.uint64(256) + code, packed)
    word = ((packed * _MIX) >> np.uint64(53)).astype(np.int64)
    word = np.where((kind == _LETTER) & (length <= 8), np.maximum(word, 2), 1)
    group = np.zeros(n, dtype=np.int64)
    for begin, text in zip(text_starts.tolist(), texts):
        for a, b, feature in _numbers(text):
            i, j = np.searchsorted(starts, (begin + a, begin + b))
            group[i:j] = feature

    last = np.ones(n, dtype=bool)
    last[:-1] = first[1:]

    def shifted(values: np.ndarray, by: int, edge: int) -> np.ndarray:
        out = np.full(n, edge, dtype=np.int64)
        if by > 0:
            out[by:] = values[:-by] if n > by else values[:0]
            stop = first.copy()
            for k in range(1, by):
                stop[k:] |= first[:-k]
        else:
            out[:by] = values[-by:] if n > -by else values[:0]
            stop = last.copy()
            for k in range(1, -by):
                stop[:-k] |= last[k:]
        out[stop] = edge
        return out

    gap = np.zeros(n, dtype=np.int64)
    gap[1:] = starts[1:] > ends[:-1]
    next_gap = np.append(gap[1:], 0)
    before, after = shifted(shape, 1, EDGE), shifted(shape, -1, EDGE)
    pair = ((before * SHAPES + shape) * 2 + gap).astype(np.uint64)
    pair = ((pair * _MIX) >> np.uint64(51)).astype(np.int64)
    following = ((after * SHAPES + shape) * 2 + next_gap).astype(np.uint64)
    following = ((following * _MIX) >> np.uint64(51)).astype(np.int64)
    blocks = (
        shape,
        before * 2 + gap,
        after * 2 + next_gap,
        shifted(shape, 2, EDGE),
        shifted(shape, -2, EDGE),
        pair,
        following,
        word,
        shifted(word, 1, 0),
        shifted(word, -1, 0),
        group,
    )
    return Tokens(starts, ends, np.flatnonzero(first), np.stack(blocks) + _STARTS[:, None], text_starts)


# ---------------------------------------------------------------- the field


@dataclass
class Field:
    """Weights: features x labels, and labels x labels with one more row for the start of a line."""

    emit: np.ndarray
    move: np.ndarray


def _scores(field: Field, features: np.ndarray) -> np.ndarray:
    total = np.zeros((features.shape[1], len(LABELS)), dtype=field.emit.dtype)
    for row in features:
        total += field.emit[row]
    return total


def _open_lines(field: Field, scores: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Lines on which another path than "nothing anywhere" can be the best one.

    Against that path, tokens of another label gain at most their best score difference and the best move inside such a run, and
    every run pays at least the cheapest way in and out.  A line whose gains cannot pay for one run is decided.
    """
    move, begin = field.move[:-1], field.move[-1]
    stay = move[1:, 1:].max() - move[0, 0]
    way_in = max((move[0, 1:] - move[0, 0]).max(), (begin[1:] - begin[0]).max())
    way_out = max((move[1:, 0] - move[0, 0]).max(), 0.0)
    gain = (scores[:, 1:] - scores[:, :1]).max(axis=1)
    # a run of r tokens gains the sum of its differences, r - 1 moves inside, one way in and at most one way out
    worth = np.maximum(gain + max(stay, 0.0), 0.0)
    if way_in + way_out > 0:
        worth += np.maximum(gain + max(stay, 0.0) + way_in + way_out, 0.0)
    total = np.add.reduceat(worth, lines)
    return total + min(way_in + way_out, 0.0) > -1e-2  # room for rounding


def _solve(scores: np.ndarray, starts: np.ndarray, sizes: np.ndarray, enter: np.ndarray, move: np.ndarray):
    """Best scores of blocks for every row of ``enter`` (what may lie before) and last label, with the steps taken.

    Blocks come longest first, so the ones that go on at a step are the first ones.
    """
    count = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right")
    best = enter[None] + scores[starts][:, None, :]
    steps = []
    for s in range(1, len(count)):
        on = count[s]
        ways = best[:on, :, :, None] + move[None, None]
        steps.append(ways.argmax(axis=2).astype(np.int8))
        best[:on] = ways.max(axis=2) + scores[starts[:on] + s][:, None, :]
    return best, steps, count


def _walk(labels: np.ndarray, starts: np.ndarray, count, steps, row: np.ndarray, last: np.ndarray) -> None:
    """Writes the labels of the blocks, whose chosen row and last label are given."""
    now = last.copy()
    for s in range(len(count) - 1, 0, -1):
        on = count[s]
        labels[starts[:on] + s] = now[:on]
        now[:on] = steps[s - 1][np.arange(on), row[:on], now[:on]]
    labels[starts] = now


def decode(field: Field, tokens: Tokens) -> np.ndarray:
    """The best label of every token: Viterbi of every line, block by block."""
    n = len(tokens.starts)
    labels = np.zeros(n, dtype=np.int64)
    if not n:
        return labels
    scores = _scores(field, tokens.features)
    begin, move = field.move[-1:], field.move[:-1]
    sizes = np.diff(np.append(tokens.lines, n))
    is_open = _open_lines(field, scores, tokens.lines)
    short = is_open & (sizes <= BLOCK)
    order = np.argsort(-sizes[short], kind="stable")
    starts, lengths = tokens.lines[short][order], sizes[short][order]
    if len(starts):
        best, steps, count = _solve(scores, starts, lengths, begin, move)
        _walk(labels, starts, count, steps, np.zeros(len(starts), dtype=np.int64), best[:, 0].argmax(axis=1))
    first, whole = tokens.lines[is_open & ~short], sizes[is_open & ~short]
    if not len(first):
        return labels
    blocks = -(-whole // BLOCK)
    line = np.repeat(np.arange(len(first)), blocks)
    at = np.arange(len(line)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    starts = first[line] + at * BLOCK
    lengths = np.minimum(BLOCK, first[line] + whole[line] - starts)
    order = np.argsort(-lengths, kind="stable")
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    best, steps, count = _solve(scores, starts[order], lengths[order], field.move, move)
    row, last = np.zeros(len(order), dtype=np.int64), np.zeros(len(order), dtype=np.int64)
    begins = np.cumsum(blocks) - blocks
    for b, m in zip(begins.tolist(), blocks.tolist()):
        total = np.concatenate((np.full(len(LABELS), -np.inf), [0.0]))
        rows = np.zeros((m, len(LABELS)), dtype=np.int64)
        for i in range(m):
            ways = total[:, None] + best[place[b + i]]
            rows[i] = ways.argmax(axis=0)
            total = np.append(ways.max(axis=0), -np.inf)
        label = int(total[:-1].argmax())
        for i in range(m - 1, -1, -1):
            last[place[b + i]], row[place[b + i]] = label, rows[i][label]
            label = int(rows[i][label])
    _walk(labels, starts[order], count, steps, row, last)
    return labels


def _spans(tokens: Tokens, labels: np.ndarray) -> Iterator[tuple[int, str, int, int]]:
    """(text, kind, start, end) of the runs of one label inside a line."""
    n = len(labels)
    if not n or not labels.any():
        return
    cut = np.ones(n, dtype=bool)
    cut[1:] = labels[1:] != labels[:-1]
    cut[tokens.lines] = True
    begins = np.flatnonzero(cut)
    stops = np.append(begins[1:], n) - 1
    for i in np.flatnonzero(labels[begins]):
        start, end = int(tokens.starts[begins[i]]), int(tokens.ends[stops[i]])
        text = int(np.searchsorted(tokens.texts, start, side="right")) - 1
        yield text, LABELS[labels[begins[i]]], start - int(tokens.texts[text]), end - int(tokens.texts[text])


def _pieces(text: str) -> Iterator[tuple[int, str]]:
    """(place, part) of the text in whole lines; a line longer than ``PIECE`` is one part."""
    start = 0
    while start < len(text):
        end = len(text)
        if end - start > PIECE:
            cut = text.rfind("\n", start, start + PIECE)
            cut = text.find("\n", start + PIECE) if cut <= start else cut
            end = len(text) if cut < 0 else cut
        yield start, text[start:end]
        start = end + 1


def field_spans(field: Field | None, texts: list[str]) -> list[list[Span]]:
    """Spans that the field finds in every text."""
    found: list[list[Span]] = [[] for _ in texts]
    if field is None:
        return found

    def flush() -> None:
        tokens = tokenise([p for _, _, p in held])
        for i, kind, a, b in _spans(tokens, decode(field, tokens)):
            owner, place, _ = held[i]
            found[owner].append((kind, place + a, place + b))

    held: list[tuple[int, int, str]] = []
    chars = 0
    for owner, text in enumerate(texts):
        for place, part in _pieces(text):
            if held and chars + len(part) > PIECE:
                flush()
                held, chars = [], 0
            held.append((owner, place, part))
            chars += len(part) + 1
    if held:
        flush()
    return found


# ---------------------------------------------------------------- training


def _target(tokens: Tokens, spans: list[list[Span]]) -> np.ndarray:
    gold = np.zeros(len(tokens.starts), dtype=np.int64)
    for begin, own in zip(tokens.texts.tolist(), spans):
        for kind, a, b in own:
            i, j = np.searchsorted(tokens.starts, (begin + a, begin + b))
            gold[i:j] = LABELS.index(kind)
    return gold


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(values - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _gradient(emit: np.ndarray, move: np.ndarray, tokens: Tokens, gold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the negative log likelihood of the labels ``gold``, by forward-backward over all lines at once."""
    n, k = len(gold), len(LABELS)
    sizes = np.diff(np.append(tokens.lines, n))
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = tokens.lines[order], sizes[order]
    count = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right")
    scores = _scores(Field(emit, move), tokens.features)
    forward, backward = np.zeros((n, k)), np.zeros((n, k))
    forward[starts] = move[-1] + scores[starts]
    for s in range(1, len(count)):
        at = starts[: count[s]] + s
        forward[at] = _log_sum(forward[at - 1][:, :, None] + move[None, :-1], 1) + scores[at]
    for s in range(len(count) - 1, 0, -1):
        at = starts[: count[s]] + s
        backward[at - 1] = _log_sum(move[None, :-1] + (scores[at] + backward[at])[:, None, :], 2)
    total = _log_sum(forward + backward, 1)
    excess = np.exp(forward + backward - total[:, None])
    first = np.zeros(n, dtype=bool)
    first[tokens.lines] = True
    inner = np.flatnonzero(~first)
    both = np.exp(forward[inner - 1][:, :, None] + move[None, :-1] + (scores[inner] + backward[inner] - total[inner, None])[:, None, :])
    move_grad = np.vstack((both.sum(axis=0), excess[first].sum(axis=0)))
    np.subtract.at(move_grad, (np.where(first, k, np.concatenate(([0], gold[:-1]))), gold), 1.0)
    excess[np.arange(n), gold] -= 1.0
    where = tokens.features.ravel()
    emit_grad = np.stack([np.bincount(where, np.tile(excess[:, j], len(SIZES)), len(emit)) for j in range(k)], axis=1)
    return emit_grad, move_grad


def train(
    rows: list[tuple[str, list[Span]]], rounds: int = 6, batch: int = 256, rate: float = 0.1, penalty: float = 0.02, seed: int = 5
) -> Field | None:
    """Field of greatest penalised likelihood on labelled texts: Adam on batches, with the rate falling to zero."""
    rows = [(t.replace("\n", " "), s) for t, s in rows if t.strip()]
    if not rows:
        return None
    random.Random(seed).shuffle(rows)
    parts = []
    for start in range(0, len(rows), batch):
        tokens = tokenise([t for t, _ in rows[start : start + batch]])
        if len(tokens.starts):
            parts.append((tokens, _target(tokens, [s for _, s in rows[start : start + batch]])))
    rounds = max(rounds, -(-60 // max(len(parts), 1)))  # few rows: still enough updates
    emit, move = np.zeros((int(sum(SIZES)), len(LABELS))), np.zeros((len(LABELS) + 1, len(LABELS)))
    state = [np.zeros_like(x) for x in (emit, emit, move, move)]
    t, updates = 0, rounds * len(parts)
    for _ in range(rounds):
        for tokens, gold in parts:
            t += 1
            grads = _gradient(emit, move, tokens, gold)
            for x, g, i in ((emit, grads[0], 0), (move, grads[1], 2)):
                g = g + penalty * x
                state[i] = 0.9 * state[i] + 0.1 * g
                state[i + 1] = 0.99 * state[i + 1] + 0.01 * g * g
                step = rate * (1 - (t - 1) / updates)
                x -= step * (state[i] / (1 - 0.9**t)) / (np.sqrt(state[i + 1] / (1 - 0.99**t)) + 1e-8)
    return Field(emit.astype(np.float32), move.astype(np.float32))


def _digits(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def _checked(rng: random.Random, n: int, right: bool) -> str:
    body = _digits(rng, n - 1)
    good = next(d for d in "0123456789" if luhn(body + d))
    return body + (good if right else str((int(good) + rng.randrange(1, 10)) % 10))


def _grouped(digits: str, mark: str) -> str:
    return mark.join(digits[i : i + 4] for i in range(0, len(digits), 4))


def rewritten(kind: str, value: str, rng: random.Random) -> list[tuple[str, bool]]:
    """(form, is personal data): other ways to write a value of this kind, and spoilt ones."""
    if kind == "email":
        at, dot = rng.choice([(" at ", " dot "), (" (at) ", "."), ("[at]", "[dot]"), (" AT ", " DOT "), ("(at)", "(dot)"), (" [at] ", " [dot] ")])
        name, _, host = value.partition("@")
        word = re.split("[^A-Za-z]", name)[0] or name
        name = rng.choice([name, word, f"{word}.{rng.choice('abcdefghijklmnopqrstuvwxyz')}", f"{word}_{word}{rng.randrange(100)}"])
        return [(name + at + host.replace(".", dot), True), (f"{name} @ {host.split('.')[0]}", False)]
    if kind == "ip":
        parts = [str(rng.randrange(256)) for _ in range(4)]
        spoilt = [str(rng.randrange(256, 1000)) for _ in range(4)]
        return [(rng.choice(["[.]", "(.)", " . ", "[dot]"]).join(parts), True), (".".join(spoilt), False), (".".join(parts[:3]), False)]
    if kind == "card":
        mark = rng.choice(".._/")
        return [
            (_grouped(_checked(rng, 16, True), mark), True),
            (_checked(rng, 16, False), False),
            (_grouped(_checked(rng, 16, False), rng.choice([" ", "-", mark])), False),
            (_digits(rng, rng.choice([5, 8, 10, 12, 14])), False),
        ]
    a, b, c = _digits(rng, 3), _digits(rng, 3), _digits(rng, 4)
    form = rng.choice(["({0}) {1}-{2}", "{0}-{1}-{2}", "1 ({0}) {1}-{2}", "{0}.{1}.{2}", "001 {0} {1} {2}", "({0}) {1} {2}"])
    return [(form.format(a, b, c), True), (f"+{a[0]}", False), (f"{a} {rng.randrange(10)}", False)]


def taught(rows: Iterable[tuple[str, list[Span]]], seed: int = 5) -> list[tuple[str, list[Span]]]:
    """The labelled rows, and each span of theirs rewritten in its place."""
    rng = random.Random(seed)
    out = []
    for text, spans in rows:
        out.append((text, spans))
        for kind, a, b in spans:
            for form, counts in rewritten(kind, text[a:b], rng):
                rest = [s for s in spans if s[2] <= a] + [(k, s + len(form) - b + a, e + len(form) - b + a) for k, s, e in spans if s >= b]
                out.append((text[:a] + form + text[b:], rest + [(kind, a, a + len(form))] if counts else rest))
    return out


def _windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        kinds, texts, all_spans = [], [], []
        for text in batch.column("text").to_pylist():
            found = base_spans(text)
            for kind, a, b in found:
                low = max(text.rfind("\n", 0, a) + 1, a - MARGIN)
                high = text.find("\n", b)
                high = min(len(text) if high < 0 else high, b + MARGIN)
                inside = [s for s in found if s[1] < high and s[2] > low]
                overlaps = sum(s[1] < b and s[2] > a for s in inside) > 1
                if overlaps or b - a > 200 or any(s[1] < low or s[2] > high for s in inside):
                    continue  # a window holds whole spans, each token of at most one
                kinds.append(kind)
                texts.append(text[low:high])
                all_spans.append([{"kind": k, "start": s - low, "end": e - low} for k, s, e in inside])
            if not found and text.strip():
                at = len(text) * 2 // 5
                kinds.append("none")
                texts.append(text[at : at + 3 * MARGIN].replace("\n", " "))
                all_spans.append([])
        yield pa.RecordBatch.from_arrays(
            [pa.array(kinds, pa.string()), pa.array(texts, pa.string()), pa.array(all_spans, pa.list_(_SPAN))], ["kind", "text", "spans"]
        )


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_FOUND = pa.list_(pa.struct([*_SPAN, pa.field("origin", pa.string())]))
_SPAN_SQL = "array<struct<kind:string,start:long,end:long>>"


def labelled_windows(docs: DataFrame, documents: int = TRAIN_DOCUMENTS, windows: int = TRAIN_WINDOWS) -> DataFrame:
    """A small labelled table (kind, text, spans), made by the patterns from a part of ``docs``.

    About ``documents`` texts and then ``windows`` windows of each kind are chosen by hash, so its size does not grow with ``docs``.
    """
    texts = docs.select("text").filter("text is not null")
    share = documents / max(texts.count(), documents)
    chosen = texts.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(share * (1 << 30)) + (share == 1.0))
    cut = chosen.mapInArrow(_windows, f"kind string, text string, spans {_SPAN_SQL}")
    cut = stored(cut.dropDuplicates(["kind", "text"]), "pii-windows")
    counts = dict(cut.groupBy("kind").count().collect())
    limits = {k: int(min(1.0, windows * (4 if k == "none" else 1) / n) * (1 << 30)) for k, n in counts.items()}
    kept = F.lit(False)
    for kind, limit in limits.items():
        kept = kept | ((F.col("kind") == kind) & (F.pmod(F.xxhash64(F.lit(3), "text"), F.lit(1 << 30)) <= limit))
    return cut.filter(kept)


def fit(labelled: DataFrame) -> Field | None:
    """Field fitted to a small labelled table (text, spans); it is taken to the driver, so its size has to be bounded."""
    rows = [(r["text"], [(s["kind"], s["start"], s["end"]) for s in r["spans"]]) for r in labelled.select("text", "spans").collect()]
    return train(taught(sorted(rows)))


# ---------------------------------------------------------------- the operator

_AT = re.compile(r"(?<![A-Za-z])at(?![A-Za-z])|@", re.IGNORECASE)
_NAME = re.compile(r"[A-Za-z0-9]+")


def well_formed(kind: str, value: str) -> bool:
    """The check a span of the field has to pass, as base spans have theirs."""
    if kind == "email":
        # a name, an at and a host of two parts, of at least three different words in all
        words = [w.lower() for w in _NAME.findall(value)]
        halves = max((len(_NAME.findall(value[m.end() :])) for m in _AT.finditer(value) if _NAME.search(value[: m.start()])), default=0)
        return halves >= 2 and len(set(words) - {"at", "dot"}) >= 3 and len(value) <= 254
    digits = _NOT_DIGIT.sub("", value)
    if kind == "ip":
        parts = re.findall("[0-9]+", value)
        return len(parts) == 4 and all(map(_small, parts))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 7 <= len(digits) <= 15


def all_spans(field: Field | None, texts: list[str | None]) -> list[list[tuple[str, int, int, str]]]:
    """Spans of every text with their origin, by kind as listed and then start."""
    plain = [t or "" for t in texts]
    out = []
    for text, base, more in zip(plain, map(base_spans, plain), field_spans(field, plain)):
        starts = sorted((a, b) for _, a, b in base)
        reach = list(accumulate((b for _, b in starts), max))
        free = []
        for kind, a, b in more:
            if not well_formed(kind, text[a:b]):
                continue
            before = bisect_left(starts, (b, 0))  # base spans that begin before this one ends
            if not before or reach[before - 1] <= a:
                free.append((kind, a, b, "field"))
        found = [(*s, "pattern") for s in base] + free
        out.append(sorted(found, key=lambda s: (KINDS.index(s[0]), s[1])))
    return out


def find(docs: DataFrame, field: Field | None) -> DataFrame:
    """All columns of ``docs`` with ``pii``: kind, start, end and origin (``pattern`` or ``field``) of every span."""
    held = docs.sparkSession.sparkContext.broadcast(field)
    names = ("kind", "start", "end", "origin")

    @F.arrow_udf("array<struct<kind:string,start:long,end:long,origin:string>>")
    def spans(texts: pa.Array) -> pa.Array:
        found = []
        for start in range(0, len(texts), 500):
            rows = all_spans(held.value, texts.slice(start, 500).to_pylist())
            found += [[dict(zip(names, s)) for s in row] for row in rows]
        return pa.array(found, _FOUND)

    return docs.withColumn("pii", spans(F.col("text")))


def masked(found: DataFrame) -> DataFrame:
    """A table of :func:`find` with every span in ``text`` replaced by its kind in angle brackets; overlapping spans become one.

    The columns are those of ``found`` without ``pii``.
    """

    def hidden(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("pii").to_pylist()):
                done, parts = 0, []
                for s in sorted(spans or [], key=lambda s: (s["start"], -s["end"])):
                    if s["start"] >= done:
                        parts += [text[done : s["start"]], f"<{s['kind'].upper()}>"]
                    done = max(done, s["end"])
                texts.append(None if text is None else "".join(parts) + text[done:])
            keep = [n for n in batch.schema.names if n != "pii"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in keep], keep
            )

    return found.mapInArrow(hidden, found.drop("pii").schema)
