"""Splitting texts where a tokenizer always splits, and encoding pieces once.

Two boundary rules, each exact for its kind of tokenizer:

``keep``  byte-level BPE that keeps white space and may attach one leading
          space to a word. A text can be cut before an ASCII space that
          follows a character that is not white space: the pre-tokenizer
          always ends a token there, and nothing looks further left.
``drop``  tokenizers that drop white space. A text can be cut at white space.

Pieces repeat a lot, so an encoder keeps those it has met, in tables of bounded
size. The first pieces stay for ever; nearly all frequent ones are among them.
Later ones go to a young table. When it is full it takes the place of an old
one, and pieces found in the old table move up, so pieces that become frequent
later stay known and rare ones make room.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

_SPACE_BEFORE_SPACE = re.compile(r"\s ")
#: Separators that Python counts as white space and tokenizers do not.
_ODD = re.compile("[\x1c-\x1f\x85]")

#: Pieces of all tables together.
MAX_PIECES = 800_000
MAX_KEY = 48


def cut_keep(text: str) -> list[str]:
    """Pieces of a text under the ``keep`` rule, each without its one leading
    space (all but the first piece had one)."""
    parts = text.split(" ")
    if _SPACE_BEFORE_SPACE.search(text) is None and text[:1] != " ":
        return parts
    out, run = [], [parts[0]]
    last = parts[0][-1:]
    for p in parts[1:]:
        if last and not last.isspace():
            out.append(" ".join(run))
            run = [p]
        else:
            run.append(p)
        last = p[-1:] or " "
    out.append(" ".join(run))
    return out


def cut_drop(text: str) -> list[str]:
    """Pieces of a text under the ``drop`` rule."""
    return text.split() if _ODD.search(text) is None else [text]


class _Known:
    """The values of pieces met before."""

    def __init__(self, most: int):
        self.turn = max(1, most // 8)
        self.stay = max(0, most - 2 * self.turn)
        self.first, self.young, self.old = {}, {}, {}

    def keep(self, piece: str, value) -> None:
        if len(piece) > MAX_KEY:
            return
        if len(self.first) < self.stay:
            self.first[piece] = value
            return
        if len(self.young) >= self.turn:
            self.old, self.young = self.young, {}
        self.young[piece] = value

    def values(self, pieces: list[str], learn) -> list:
        """Values of pieces; ``learn(list of distinct pieces)`` gives those of
        the unknown ones."""
        vals = list(map(self.first.get, pieces))
        if None in vals:
            gaps = [i for i, v in enumerate(vals) if v is None]
            found, unknown, young, old = {}, [], self.young.get, self.old.get
            for p in dict.fromkeys([pieces[i] for i in gaps]):
                if (v := young(p)) is not None:
                    found[p] = v
                elif (v := old(p)) is not None:
                    found[p] = v
                    self.keep(p, v)
                else:
                    unknown.append(p)
            if unknown:
                for p, v in zip(unknown, learn(unknown)):
                    found[p] = v
                    self.keep(p, v)
            for i in gaps:
                vals[i] = found[pieces[i]]
        return vals


class PieceEncoder:
    """Turns texts into lists of per-piece values.

    Texts are taken in batches of about ``batch_bytes``: short texts come
    together in one, long texts are split over several at piece boundaries.
    ``encode(list of piece texts) -> list of values`` is called once for the
    distinct unknown pieces of a batch.
    """

    def __init__(self, encode, rule: str, batch_bytes: int = 1 << 21, max_pieces: int = MAX_PIECES):
        self.encode, self.rule, self.batch_bytes = encode, rule, batch_bytes
        self.first, self.rest = _Known(max_pieces // 8), _Known(max_pieces)

    def batches(self, texts: list[str]) -> Iterator[tuple[list, list[str], list]]:
        """``(texts whose first piece is here with that piece, other pieces,
        (text, first place, end) of each text in them)``."""
        firsts, pieces, spans, size = [], [], [], 0
        for i, t in enumerate(texts):
            if not t:
                continue
            cut = cut_drop(t) if self.rule == "drop" else cut_keep(t)
            n = len(t) if t.isascii() else len(t.encode())
            at = 0
            if self.rule == "keep":
                at = 1
                if cut[0]:
                    firsts.append((i, cut[0]))
            while True:
                room = self.batch_bytes - size
                if n <= room or at >= len(cut):
                    end, used = len(cut), n
                else:
                    end, used = at, 0
                    while end < len(cut) and used < room:
                        used += len(cut[end].encode()) + 1
                        end += 1
                spans.append((i, len(pieces), len(pieces) + end - at))
                pieces += cut[at:end]
                size, n, at = size + used, max(0, n - used), end
                if size >= self.batch_bytes or at < len(cut):
                    yield firsts, pieces, spans
                    firsts, pieces, spans, size = [], [], [], 0
                if at >= len(cut):
                    break
        if spans:
            yield firsts, pieces, spans

    def many(self, texts: list[str]) -> list[list]:
        """Values of the pieces of every text, in order (empty text: none)."""
        out: list[list] = [[] for _ in texts]
        lead = "" if self.rule == "drop" else " "
        for firsts, pieces, spans in self.batches(texts):
            for (i, _), v in zip(firsts, self.first.values([p for _, p in firsts], self.encode)):
                out[i].append(v)
            vals = self.rest.values(pieces, lambda ps: self.encode([lead + p for p in ps] if lead else ps))
            for i, a, z in spans:
                out[i] += vals[a:z]
        return out

    def __call__(self, text: str) -> list:
        return self.many([text])[0]


_LOADED: dict = {}


def load_tokenizer(spec: str):
    """Tokenizer of a JSON document, once in each worker process."""
    key = hash(spec)
    if key not in _LOADED:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        t = Tokenizer.from_str(spec)
        t.no_truncation()
        t.no_padding()
        _LOADED[key] = t
    return _LOADED[key]


def read_spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


_ENCODERS: dict = {}


def worker_encoder(key: tuple, make) -> PieceEncoder:
    """One encoder per worker process and key: tasks that follow each other in
    a worker share its table of pieces."""
    if key not in _ENCODERS:
        _ENCODERS[key] = make()
    return _ENCODERS[key]
