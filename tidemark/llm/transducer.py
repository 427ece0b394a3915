"""A minimal acyclic transducer from words to id sequences.

Sorted words are added one by one to an automaton whose equal suffixes are
merged as soon as they are complete. Each arc carries a number; the numbers
along a word's path add up to the word's place in the sorted list, which is
where its ids are. The automaton is one block of flat arrays that a process
maps into memory and reads in place.
"""

from __future__ import annotations

import json
import mmap

import numpy as np

_ARRAYS = (("arc_start", "<u4"), ("labels", "u1"), ("targets", "<u4"), ("outputs", "<u4"), ("final", "u1"),
           ("id_start", "<u4"), ("ids", "<u4"))


def compile_transducer(entries: dict[bytes, tuple[int, ...]]) -> bytes:
    """The file content for words and their ids."""
    words = sorted(entries)
    arcs: list[list[tuple[int, int]]] = [[]]
    final: list[bool] = [False]
    register: dict = {}
    path = [0]
    previous = b""

    def settle(down_to: int) -> None:
        """Replaces the open states below a depth by equal ones known before."""
        while len(path) > down_to + 1:
            state = path.pop()
            shape = (final[state], tuple(arcs[state]))
            known = register.setdefault(shape, state)
            label, _ = arcs[path[-1]][-1]
            arcs[path[-1]][-1] = (label, known)

    for w in words:
        same = 0
        while same < min(len(w), len(previous)) and w[same] == previous[same]:
            same += 1
        settle(same)
        for c in w[same:]:
            arcs.append([])
            final.append(False)
            arcs[path[-1]].append((c, len(arcs) - 1))
            path.append(len(arcs) - 1)
        final[path[-1]] = True
        previous = w
    settle(0)

    number: dict[int, int] = {}
    order: list[int] = []
    stack = [0]
    while stack:
        s = stack.pop()
        if s not in number:
            number[s] = len(order)
            order.append(s)
            stack.extend(t for _, t in arcs[s])
    reach: dict[int, int] = {}
    for s in _children_first(arcs):
        reach[s] = int(final[s]) + sum(reach[t] for _, t in arcs[s])
    start, labels, targets, outputs = [0], [], [], []
    for s in order:
        skipped = int(final[s])
        for label, t in arcs[s]:
            labels.append(label)
            targets.append(number[t])
            outputs.append(skipped)
            skipped += reach[t]
        start.append(len(labels))
    id_start = np.zeros(len(words) + 1, dtype=np.int64)
    id_start[1:] = np.cumsum([len(entries[w]) for w in words])
    parts = {"arc_start": start, "labels": labels, "targets": targets, "outputs": outputs,
             "final": [int(final[s]) for s in order], "id_start": id_start,
             "ids": [i for w in words for i in entries[w]]}
    blobs, at, places = [], 0, {}
    for name, kind in _ARRAYS:
        b = np.asarray(parts[name], dtype=kind).tobytes()
        places[name] = (at, len(b))
        b += b"\0" * (-len(b) % 4)
        blobs.append(b)
        at += len(b)
    head = json.dumps(places).encode()
    head += b" " * (-len(head) % 4)
    return len(head).to_bytes(4, "little") + head + b"".join(blobs)


def _children_first(arcs) -> list[int]:
    done, out, stack = set(), [], [(0, False)]
    while stack:
        s, ready = stack.pop()
        if ready:
            out.append(s)
        elif s not in done:
            done.add(s)
            stack.append((s, True))
            stack.extend((t, False) for _, t in arcs[s] if t not in done)
    return out


class Transducer:
    """Reads a compiled transducer in place, from a file or from bytes."""

    def __init__(self, source: str | bytes):
        if isinstance(source, bytes):
            self.data = mmap.mmap(-1, len(source))
            self.data.write(source)
        else:
            with open(source, "rb") as f:
                self.data = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        view = memoryview(self.data)
        size = int.from_bytes(view[:4], "little")
        places = json.loads(bytes(view[4:4 + size]))
        for name, kind in _ARRAYS:
            at, n = places[name]
            at += 4 + size
            part = view[at:at + n]
            setattr(self, name, part.cast("I") if kind == "<u4" else part)
            if name == "labels":
                self.labels_at = at
        self.n_states = len(self.final)
        # State and label of every arc as one number; arcs are stored in that order.
        arcs = np.diff(np.frombuffer(self.arc_start, dtype="<u4").astype(np.int64))
        self.arc_keys = (np.repeat(np.arange(self.n_states, dtype=np.int64), arcs) << 8) | np.frombuffer(self.labels, dtype=np.uint8)
        self.arc_targets, self.arc_outputs = (np.frombuffer(x, dtype="<u4") for x in (self.targets, self.outputs))
        self.final_states = np.frombuffer(self.final, dtype=np.uint8)

    def place(self, word: bytes) -> int:
        """Place of a word in the sorted list, -1 if it is not there."""
        find, start, targets, outputs, base = self.data.find, self.arc_start, self.targets, self.outputs, self.labels_at
        state = out = 0
        for i in range(len(word)):
            arc = find(word[i:i + 1], base + start[state], base + start[state + 1]) - base
            if arc < 0:
                return -1
            out += outputs[arc]
            state = targets[arc]
        return out if self.final[state] else -1

    def places(self, words: list[bytes]) -> np.ndarray:
        """``place`` of many words: they all take their next arc together, and
        those without one drop out."""
        out = np.full(len(words), -1, dtype=np.int64)
        if not len(self.arc_keys):
            return out
        size = np.array([len(w) for w in words], dtype=np.int64)
        letters = np.frombuffer(b"".join(words), dtype=np.uint8).astype(np.int64)
        at = np.cumsum(size) - size
        live, state, sums, step = np.arange(len(words)), np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64), 0
        while len(live):
            ended = size[live] == step
            if ended.any():
                e, s = live[ended], state[ended]
                out[e] = np.where(self.final_states[s] > 0, sums[ended], -1)
                live, state, sums = live[~ended], state[~ended], sums[~ended]
            key = (state << 8) | letters[at[live] + step]
            arc = np.minimum(np.searchsorted(self.arc_keys, key), len(self.arc_keys) - 1)
            found = self.arc_keys[arc] == key
            arc, live = arc[found], live[found]
            state, sums = self.arc_targets[arc].astype(np.int64), sums[found] + self.arc_outputs[arc]
            step += 1
        return out

    def get(self, word: bytes) -> tuple[int, ...] | None:
        """Ids of a word, None if it is not there."""
        k = self.place(word)
        return None if k < 0 else tuple(self.ids[self.id_start[k]:self.id_start[k + 1]])
