"""Personal data by patterns and by a linear-chain conditional random field.

Patterns find e-mail addresses, IP addresses, card and international phone
numbers. The model adds what has no fixed pattern: local phone numbers, written
out addresses, identity numbers, names after a title. It labels tokens from
their shapes and those of their neighbours, is trained here from a small
labelled table by gradient ascent on the likelihood (forward-backward), and is
decoded by Viterbi over batches of whole texts in numpy.

Every token of every text is labelled: texts are never cut short, and nothing but
the model decides where it looks. Tokens, features and Viterbi steps are numpy
operations over many texts at once, with the weights of features in tables by the
shapes of neighbours.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from aidmatch.llm.common import whole_text
from aidmatch.llm.pii_labelled import LABELLED

BASE = ["email", "ip", "card", "phone"]
#: Labels of the model and the names of their spans.
KINDS = {"phone": "crf_phone", "mail": "crf_mail", "id": "crf_id", "name": "crf_name"}
LABELS = ["O", *(f"{at}-{kind}" for kind in KINDS for at in "BI")]
STEPS = 200
PENALTY = 0.05
#: Code points that are decoded at once; a longer text is decoded alone.
BATCH = 1 << 22

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile("[0-9]")
_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|[^\w\s]|_")
#: Titles and cue words of the table; they are features of their own.
CUES = frozenset(
    "mr mrs ms dr herr frau mme sr sra m ssn security number dni nie iban passport ausweis tel telefon telefono phone call ring "
    "mobile handy fax llame mail email write contact reach at dot arroba punto nr no".split()
)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: a local part is the run before an at sign, down to the last match."""
    done, at = 0, text.find("@")
    while at >= 0:
        low = at
        while low > done and text[low - 1] in _LOCAL:
            low -= 1
        match = _DOMAIN.match(text, at + 1) if low < at else None
        if match:
            yield low, match.end()
            done = match.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    total = 0
    for nth, d in enumerate(reversed(digits)):
        n = int(d) * (1 + nth % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Places of each kind of ``BASE``."""
    found: list[list[tuple[int, int]]] = [list(_emails(text)), [], [], []]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") for p in m.groups()]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                found[1].append(m.span())
        for m in _CARD.finditer(text):
            if m.end() - m.start() <= 37:
                digits = m[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and _luhn(digits):
                    found[2].append(m.span())
        for m in _PHONE.finditer(text):
            if 8 <= sum(map(str.isdigit, m[0])) <= 15:
                found[3].append(m.span())
    return found


def _shape(token: str) -> str:
    if token.isdigit():
        return f"d{min(len(token), 9)}"
    if token.isalpha():
        form = "A" if token.isupper() else "Aa" if token[0].isupper() else "a"
        return form + ("1" if len(token) == 1 else "")
    return token


def _features(tokens: list[str], gaps: list[bool]) -> list[list[str]]:
    """Names of the features of every token; ``gaps`` tells where white space comes before it."""
    shapes = ["^", "^", *map(_shape, tokens), "$", "$"]
    words = ["^", "^", *(t.lower() if t.lower() in CUES else "" for t in tokens), "$", "$"]
    glued = [True, *(not g for g in gaps[1:]), True]
    out = []
    for i in range(len(tokens)):
        s, w = shapes[i:i + 5], words[i:i + 5]
        out.append([
            "bias", f"s0={s[2]}", f"s-={s[1]}", f"s+={s[3]}", f"s-0={s[1]}|{s[2]}|{glued[i]}", f"s0+={s[2]}|{s[3]}|{glued[i + 1]}",
            f"w0={w[2]}", f"w-={w[1]}", f"w--={w[0]}", f"w+={w[3]}", f"s--={s[0]}|{s[1]}", f"s-0+={s[1]}|{s[2]}|{s[3]}", f"g={glued[i]}|{glued[i + 1]}",
        ])
    return out


def _tokens(text: str, low: int = 0, high: int | None = None) -> tuple[list[tuple[int, int]], list[str], list[bool]]:
    places = [m.span() for m in _TOKEN.finditer(text, low, len(text) if high is None else high)]
    return places, [text[a:b] for a, b in places], [i == 0 or a > places[i - 1][1] for i, (a, _) in enumerate(places)]


def _parse(row: str) -> tuple[list[list[str]], list[int]]:
    """Features and labels of the tokens of a marked row."""
    text, spans, at = "", [], 0
    for m in re.finditer(r"\[(phone|mail|id|name)\|((?:[^\[\]]|\[[^\]|]*\])*)\]", row):
        text += row[at:m.start()]
        spans.append((len(text), len(text) + len(m[2]), m[1]))
        text, at = text + m[2], m.end()
    text += row[at:]
    places, tokens, gaps = _tokens(text)
    labels = [0] * len(tokens)
    for low, high, kind in spans:
        inside = [i for i, (a, b) in enumerate(places) if low <= a and b <= high]
        for nth, i in enumerate(inside):
            labels[i] = LABELS.index(f"{'I' if nth else 'B'}-{kind}")
    return _features(tokens, gaps), labels


class Crf:
    """Weights of features by label and of label pairs."""

    def __init__(self, names: dict[str, int], emit: np.ndarray, move: np.ndarray):
        self.names, self.emit, self.move = names, emit, move

    def scores(self, features: list[list[str]]) -> np.ndarray:
        """(tokens, labels); feature 0 stands for all that training has not seen."""
        return self.emit[[[self.names.get(f, 0) for f in row] for row in features]].sum(axis=1)

    def decode(self, runs: list[np.ndarray]) -> list[np.ndarray]:
        """The best labels of every run of token scores."""
        lengths = np.array([len(run) for run in runs], dtype=np.int64)
        labels = self.decode_all(np.concatenate([*runs, np.empty((0, len(LABELS)))]), lengths)
        return np.split(labels, np.cumsum(lengths)[:-1])

    def decode_all(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The best labels of runs of so many tokens, one run after the other in ``scores``, which are used up.

        A step is one token of each run that is that long; the way back finds the best label before
        the chosen one anew, so only the best sums are kept, in place of the scores.
        """
        order = np.argsort(-lengths, kind="stable")
        first, many = (np.cumsum(lengths) - lengths)[order], lengths[order]
        longest = int(many.max(initial=0))
        active = np.searchsorted(-many, -np.arange(longest), side="left")  # runs of more than t tokens
        at = first[:active[0]] if longest else first[:0]
        scores[at] += _START
        move = np.ascontiguousarray(self.move)[:, :, None]
        state = scores[at].T
        for t in range(1, longest):
            at = first[:active[t]] + t
            state = (state[:, None, :active[t]] + move).max(axis=0) + scores[at].T
            scores[at] = state.T
        labels = np.zeros(len(scores), dtype=np.int64)
        ends = first[many > 0] + many[many > 0] - 1
        labels[ends] = scores[ends].argmax(axis=1)
        into = np.ascontiguousarray(self.move.T)
        for t in range(longest - 1, 0, -1):
            at = first[:active[t]] + t
            labels[at - 1] = (scores[at - 1] + into[labels[at]]).argmax(axis=1)
        return labels


#: An I label follows a B or I of its kind only.
_ALLOWED = np.array([[b[0] != "I" or (a != "O" and a[2:] == b[2:]) for b in LABELS] for a in LABELS])
_INSIDE = np.array([b[0] == "I" for b in LABELS])
_START = np.where(_INSIDE, -1e9, 0.0)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def train(rows: list[str] = LABELLED, steps: int = STEPS) -> Crf:
    """Maximise the penalised likelihood of a labelled table; the same table gives the same model."""
    parsed = [_parse(row) for row in rows]
    names = {"": 0}
    for features, _ in parsed:
        for row in features:
            for f in row:
                names.setdefault(f, len(names))
    longest, many, kinds = max(len(y) for _, y in parsed), len(parsed), len(LABELS)
    width = len(parsed[0][0][0])
    index = np.zeros((many, longest, width), dtype=np.int64)
    gold, there = np.zeros((many, longest), dtype=np.int64), np.zeros((many, longest), dtype=bool)
    for i, (features, labels) in enumerate(parsed):
        index[i, :len(labels)] = [[names[f] for f in row] for row in features]
        gold[i, :len(labels)], there[i, :len(labels)] = labels, True
    # the tokens of each feature, side by side
    uses = index[there].ravel()
    by_name = np.argsort(uses, kind="stable")
    users, begins = by_name // width, np.flatnonzero(np.diff(uses[by_name], prepend=-1))
    used = uses[by_name][begins]
    emit, move = np.zeros((len(names), kinds)), np.where(_ALLOWED, 0.0, -1e9)
    grown = [np.zeros_like(emit), np.zeros_like(move)]
    for step in range(steps):
        scores = emit[index].sum(axis=2)
        ahead = np.zeros((longest, many, kinds))
        ahead[0] = scores[:, 0] + _START
        for t in range(1, longest):
            on = _log_sum(ahead[t - 1][:, :, None] + move, 1) + scores[:, t]
            ahead[t] = np.where(there[:, t, None], on, ahead[t - 1])
        total = _log_sum(ahead[-1], 1)
        behind = np.zeros((longest, many, kinds))
        for t in range(longest - 2, -1, -1):
            on = _log_sum(move[None] + (scores[:, t + 1] + behind[t + 1])[:, None, :], 2)
            behind[t] = np.where(there[:, t + 1, None], on, behind[t + 1])
        chance = np.exp(ahead + behind - total[None, :, None]).transpose(1, 0, 2) * there[:, :, None]
        error = np.eye(kinds)[gold] * there[:, :, None] - chance
        up_emit = np.zeros_like(emit)
        up_emit[used] = np.add.reduceat(error[there][users], begins, axis=0)
        up_move = np.zeros_like(move)
        for t in range(1, longest):
            on = there[:, t]
            pair = np.exp(ahead[t - 1][:, :, None] + move + (scores[:, t] + behind[t])[:, None, :] - total[:, None, None])
            up_move -= pair[on].sum(axis=0)
            np.add.at(up_move, (gold[on, t - 1], gold[on, t]), 1)
        for weights, up, past in ((emit, up_emit - PENALTY * emit, grown[0]), (move, np.where(_ALLOWED, up_move - PENALTY * np.where(_ALLOWED, move, 0), 0), grown[1])):
            past += up**2  # step sizes by the gradients so far
            weights += 0.5 * up / np.sqrt(past + 1e-8)
        emit[0] = 0
    return Crf(names, emit, move)


def _reaches(text: str) -> list[tuple[int, int]]:
    """The parts of a text that the model labels: all of it."""
    return [(0, len(text))]


_LETTER, _NUMBER, _SIGN = 1, 2, 3
#: What a letter can be besides: upper case, lower or title case, not of an alphabet.
_UPPER, _LOWER, _OTHER = 1, 2, 4
_MOST = max(map(len, CUES))


@lru_cache
def _characters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: the kind of token, what a letter can be, and its place among the small letters a to z, 0 for none."""
    every = "".join(map(chr, range(0x110000)))
    kind, case, small = (np.zeros(len(every), dtype=np.uint8) for _ in range(3))
    kind[ord("0"):ord("9") + 1] = _NUMBER
    for m in re.finditer(r"(?:[^\w\s]|_)+", every):
        kind[m.start():m.end()] = _SIGN
    for m in re.finditer(r"[^\W\d_]+", every):
        kind[m.start():m.end()] = _LETTER
        for at in range(*m.span()):
            c = every[at]
            case[at] = _UPPER * c.isupper() | _LOWER * (c.islower() or (c.istitle() and not c.isupper())) | _OTHER * (not c.isalpha())
            if "a" <= c.lower() <= "z" and len(c.lower()) == 1:
                small[at] = ord(c.lower()) - ord("a") + 1
    return kind, case, small


def _cue_code(word: str) -> int:
    return sum(ord(c) - ord("a") + 1 << 5 * i for i, c in enumerate(word))


class Tables:
    """The weights of a model by numbers of shapes and cue words instead of names."""

    def __init__(self, model: Crf):
        named = {kind: {} for kind in ("s0", "s-", "s+", "s-0", "s0+", "s--", "s-0+", "w0", "w-", "w--", "w+", "g")}
        for name, at in model.names.items():
            kind, is_, value = name.partition("=")
            if is_ and at:
                named[kind][value] = model.emit[at]
        bias = model.emit[model.names["bias"]]
        # number 0 is a shape that training has not seen
        self.shapes = {s: i for i, s in enumerate(sorted({*named["s0"], *named["s-"], *named["s+"], "^", "$"}), 1)}
        self.cues = {w: i for i, w in enumerate(["", "^", "$", *sorted(CUES)])}
        many, kinds = len(self.shapes) + 1, len(LABELS)
        glued = {"False": 0, "True": 1}

        def table(kind: str, *numbers: dict[str, int]) -> np.ndarray:
            out = np.zeros((*(many if n is self.shapes else len(n) for n in numbers), kinds))
            for value, weights in named[kind].items():
                parts = _bars(value, len(numbers))
                if all(p in n for p, n in zip(parts, numbers)):
                    out[tuple(n[p] for p, n in zip(parts, numbers))] = weights
            return out

        one = self.shapes
        here, before, after = (table(k, one) for k in ("s0", "s-", "s+"))
        # by the shape before, that of the token, that after, and whether they stick together
        self.near = (
            bias + before[:, None, None, None, None] + here[None, :, None, None, None] + after[None, None, :, None, None]
            + table("s-0+", one, one, one)[:, :, :, None, None] + table("s-0", one, one, glued)[:, :, None, :, None]
            + table("s0+", one, one, glued)[None, :, :, None, :] + table("g", glued, glued)[None, None, None]
        ).reshape(-1, kinds)
        self.far = table("s--", one, one).reshape(-1, kinds)
        self.word = [table(k, self.cues) for k in ("w0", "w-", "w--", "w+")]
        self.sign = np.zeros(0x110000, dtype=np.int64)
        for s, i in self.shapes.items():
            if len(s) == 1 and _characters()[0][ord(s)] == _SIGN:
                self.sign[ord(s)] = i
        for edge in "^$":
            self.sign[ord(edge)] = self.shapes[edge]
        shape = lambda s: self.shapes.get(s, 0)
        self.numbers = np.array([0, *(shape(f"d{n}") for n in range(1, 10))])
        self.letters = np.array([[shape(f), shape(f"{f}1")] for f in ("a", "Aa", "A")])
        codes = {_cue_code(w): self.cues[w] for w in CUES}
        self.codes = np.array(sorted(codes))
        self.of_code = np.array([codes[c] for c in self.codes.tolist()])

    def tokens(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the tokens of all texts, places in them, the number of tokens in each, and the scores of the tokens."""
        kinds, cases, small = _characters()
        joined = "\n".join(texts)  # no token holds a line end
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        kind = kinds[points]
        single, new = kind == _SIGN, np.ones(len(kind) + 1, dtype=bool)
        new[1:-1] = kind[1:] != kind[:-1]
        starts = np.flatnonzero((kind > 0) & (single | new[:-1]))
        ends = np.flatnonzero((kind > 0) & (single | new[1:])) + 1
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
        first = np.searchsorted(starts, begins)
        lengths = np.diff(np.r_[first, len(starts)])
        size, kind = ends - starts, kind[starts]
        lead = points[starts]

        shape, cue = np.zeros(len(starts), dtype=np.int64), np.zeros(len(starts), dtype=np.int64)
        some = kind == _SIGN
        shape[some] = self.sign[lead[some]]
        some = kind == _NUMBER
        shape[some] = self.numbers[np.minimum(size[some], 9)]
        some = np.flatnonzero(kind == _LETTER)
        if len(some):
            case = cases[points]
            # letters of a token lie between its start and the next one's, where all else has no case
            held = np.bitwise_or.reduceat(case, starts)[some]
            form = np.where(held & (_UPPER | _LOWER) == _UPPER, 2, (case[starts[some]] & _UPPER > 0).astype(np.int64))
            shape[some] = self.letters[form, (size[some] == 1).astype(np.int64)]
            for i in some[held & _OTHER > 0].tolist():
                shape[i] = self.shapes.get(_shape(joined[starts[i]:ends[i]]), 0)
            some = some[size[some] <= _MOST]
            code = np.zeros(len(some), dtype=np.int64)
            left = np.arange(len(some))
            for nth in range(_MOST):
                left = left[size[some[left]] > nth]
                letter = small[points[starts[some[left]] + nth]].astype(np.int64)
                code[left] += letter << 5 * nth
                code[left[letter == 0]] = -1
                left = left[letter > 0]
            at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            cue[some] = np.where(self.codes[at] == code, self.of_code[at], 0)

        there = lengths > 0
        opening, closing = first[there], first[there] + lengths[there] - 1

        def beside(of: np.ndarray, start: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """What is one before, two before and one after each token, in its text."""
            one = np.r_[start, of[:-1]][:len(of)]
            one[opening] = start
            two = np.r_[start, one[:-1]][:len(of)]
            two[opening] = start
            after = np.r_[of[1:], end][:len(of)]
            after[closing] = end
            return one, two, after

        before, before2, after = beside(shape, self.shapes["^"], self.shapes["$"])
        sticks = np.ones(len(starts) + 1, dtype=np.int64)
        sticks[1:-1] = starts[1:] == ends[:-1]
        sticks[opening] = 1
        behind = sticks[1:].copy()
        behind[closing] = 1
        many = len(self.shapes) + 1
        scores = self.near[(((before * many + shape) * many + after) * 2 + sticks[:-1]) * 2 + behind]
        scores += self.far[before2 * many + before]
        w1, w2, w_after = beside(cue, self.cues["^"], self.cues["$"])
        scores += sum(t[0] for t in self.word)
        said = np.flatnonzero(cue | w1 | w2 | w_after)
        scores[said] += sum(t[w[said]] - t[0] for t, w in zip(self.word, (cue, w1, w2, w_after)))
        base = np.repeat(begins, lengths)
        return starts - base, ends - base, lengths, scores


def _bars(value: str, many: int) -> list[str]:
    """The values that a feature's name joins by bars; the only one that holds a bar is a bar."""
    parts = []
    for _ in range(many - 1):
        part, value = ("|", value[2:]) if value.startswith("||") else value.split("|", 1)
        parts.append(part)
    return [*parts, value]


def find_personal_data(docs: DataFrame, text: str = "text", labelled: list[str] = LABELLED) -> DataFrame:
    """Every row as ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans``.

    Spans are ``kind:start:end`` over the whole text in code points, by kind and
    start; those of the model never overlap a pattern's. Null texts count as
    empty, rows of one id stay apart, an empty table gives an empty result,
    other columns play no part.
    """
    import hashlib

    model = train(labelled)
    added = list(KINDS.values())
    kind_of = [None, *(k for k in range(len(KINDS)) for _ in "BI")]

    def model_spans(tables: Tables, texts: list[str], taken: list[list[list[tuple[int, int]]]]) -> list[list[list[tuple[int, int]]]]:
        found = [[[] for _ in added] for _ in texts]
        starts, ends, lengths, scores = tables.tokens(texts)
        labels = model.decode_all(scores, lengths)
        owner = np.repeat(np.arange(len(texts)), lengths)
        # a span is a B label and the I labels after it
        opens = np.flatnonzero((labels > 0) & ~_INSIDE[labels])
        closes = np.flatnonzero((labels > 0) & ~np.r_[_INSIDE[labels[1:]], False][:len(labels)])
        for row, label, low, high in zip(*(x.tolist() for x in (owner[opens], labels[opens], starts[opens], ends[closes]))):
            if not any(a < high and low < b for spans in taken[row] for a, b in spans):
                found[row][kind_of[label]].append((low, high))
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables(model)
        for batch in batches:
            held = np.cumsum(pc.utf8_length(batch.column(1)).to_numpy()) // BATCH
            cuts = [0, *(np.flatnonzero(np.diff(held)) + 1).tolist(), batch.num_rows]
            for low, high in zip(cuts, cuts[1:]):
                part = batch.slice(low, high - low)
                texts = part.column(1).to_pylist()
                base = [base_spans(t) for t in texts]
                more = model_spans(tables, texts, base)
                first = [[f"{k}:{a}:{b}" for k, spans in zip(BASE, one) for a, b in spans] for one in base]
                rest = [[f"{k}:{a}:{b}" for k, spans in zip(added, one) for a, b in spans] for one in more]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array([len(one[i]) for one in base], pa.int64()) for i in range(len(BASE))),
                     pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in first]),
                     pa.array([",".join(x + y) for x, y in zip(first, rest)])],
                    names=["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", whole_text(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"
    )
