"""Plain single-process versions of the operators, to test against."""

import hashlib
import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

KINDS = ("email", "ip", "card", "phone")
PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def ascii_lower(t: str) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), t)


def quality(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    times = Counter(runs)
    places = {p for i, r in enumerate(runs) if times[r] > 1 for p in range(i, i + 8)}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(places),
            n < 20 or 100 * len(places) > 30 * n)


def contamination(docs, items):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(t or ""))
    windows = []
    for item, t in items:
        w = words(t)
        n = min(10, len(w))
        windows += [(item, tuple(w[i:i + n])) for i in range(len(w) - n + 1)] if n else []
    by_run = {}
    for item, run in windows:
        by_run.setdefault(run, set()).add(item)
    sizes = {len(r) for r in by_run}
    out = []
    for doc, t in docs:
        w = words(t)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (its := by_run.get(tuple(w[i:i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= its
        names = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), len(names), sha(",".join(names)), bool(hit)))
    return out


def simhash(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps, bits=2):
    """Index of the first member of each one's component."""
    a = np.array(fps, dtype=np.uint64)
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1:] ^ a[i]) <= bits):
            x, y = find(i), find(i + 1 + int(j))
            if x != y:
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(fps))]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def pii(text):
    out = []
    for k, kind in enumerate(KINDS):
        for m in re.finditer(PII[kind], text or ""):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                  "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), k, m.end()))
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


def jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def ids_crc32(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def id_remainder(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def spelling(rows):
    """``word, form, root, n, n_near, form_n`` of ``(id, text)`` rows, sorted."""
    times = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", t or ""):
            run = ascii_lower(run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 5:
                times[run] += 1
    n = {w: k for w, k in times.items() if k >= 3}
    return spelling_forms(n)


def spelling_forms(n):
    gaps, near = defaultdict(list), {w: set() for w in n}
    for w in n:
        for p in range(len(w)):
            gaps[p, w[:p] + w[p + 1:]].append(w)
    for (_, rest), ws in gaps.items():
        for a in ws:
            near[a].update(b for b in ws if b != a)
            if rest in n:
                near[a].add(rest)
                near[rest].add(a)
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda x: (-n[x], x))
            if n[best] >= 2 * n[w]:
                form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
    return sorted(out)


def merkle_field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def _levels(hs):
    out = [hs]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def _proof(levels, i):
    out = []
    for level in levels[:-1]:
        run = level[i // 3 * 3:i // 3 * 3 + 3]
        out.append(("".join(run[:i % 3]), "".join(run[i % 3 + 1:])))
        i //= 3
    return out


def merkle(rows):
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of
    ``(doc_id, source, lang, n_chars, text)`` rows."""
    sources = defaultdict(list)
    for d, source, lang, n, text in rows:
        leaf = other = sha("".join(map(merkle_field, (d, source, lang, n, text))))
        if d is not None and zlib.crc32(str(d).encode()) % 2 == 0 and text is not None:
            other = sha("".join(map(merkle_field, (d, source, lang, n, text.replace("\n", "")))))
        sources[source].append((d is not None, d or 0, leaf, other))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: _levels([x[2] for x in sorted(sources[s])]) for s in names}
    top = _levels([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, (has, d, leaf, other) in enumerate(sorted(sources[s])):
            path, h = _proof(trees[s], i) + _proof(top, k), other
            for before, after in path:
                h = sha(before + h + after)
            out.append((d if has else None, leaf, trees[s][-1][0], top[-1][0], sha("".join(a + b for a, b in path)), h, h == top[-1][0]))
    return out


class Ppm:
    """Byte trie with escapes by distinct bytes and symbol exclusion."""

    def __init__(self, order):
        self.order, self.seen, self.words = order, defaultdict(Counter), Counter()

    def learn(self, text):
        b = ascii_lower(text or "").encode()
        self.words.update(b.split())
        self.words[None] += 1
        s = b"\xfe" * self.order + b + b"\xff"
        for i in range(self.order, len(s)):
            for k in range(self.order + 1):
                self.seen[s[i - k:i]][s[i]] += 1

    def log(self, context, byte):
        x, out = 0.0, set()
        while True:
            here = {s: n for s, n in self.seen.get(context, {}).items() if s not in out}
            total = sum(here.values()) + len(here)
            if byte in here:
                return x + math.log10(here[byte] / total)
            if here:
                x += math.log10(len(here) / total)
                out |= set(here)
            if not context:
                return x - math.log10(256 - len(out))
            context = context[1:]

    def score(self, text):
        b = ascii_lower(text or "").encode()
        s = b"\xfe" * self.order + b + b"\xff"
        return sum(self.log(s[i - self.order:i], s[i]) for i in range(self.order, len(s)))


def lm(rows, order):
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base, score``."""
    model = Ppm(order)
    learned = lambda d: d is not None and id_remainder(d, 10) != 0
    for d, t in rows:
        if learned(d):
            model.learn(t)
    total, v = sum(model.words.values()), len(model.words)
    out = []
    for d, t in rows:
        words = [*ascii_lower(t or "").encode().split(), None]
        counts = [model.words.get(w, 0) for w in words]
        out.append((d, d is not None and not learned(d), len(words), sum(c > 0 for c in counts), total,
                    sum(math.log10((c + 0.1) / (total + 0.1 * (v + 1))) for c in counts), model.score(t)))
    return out


# -- plain forms of the trained models' predictions ----------------------------

_MASK = (1 << 64) - 1
_MIX = 0x9E3779B97F4A7C15


def _bucket(h, shift, bits):
    h ^= h >> shift
    return (h * _MIX & _MASK) >> (64 - bits)


def _gram_buckets(data, n, bits):
    """One bucket for each run of n bytes, one run at a time."""
    out = []
    for i in range(len(data) - n + 1):
        h = n
        for c in data[i:i + n]:
            h = (h << 8 | c) & _MASK
        out.append(_bucket(h, 29, bits))
    return out


def _letters(text):
    spaced = [c if 97 <= c <= 122 or c >= 128 else 32 for c in b" " + text.lower().encode() + b" "]
    return [c for i, c in enumerate(spaced) if c != 32 or i == 0 or spaced[i - 1] != 32]


def language(text, model, bits):
    """The predicted language and score: n-grams counted one by one, every
    machine asked in turn, votes told to both sides."""
    if not text or not any(c.isalpha() for c in text):
        return "und", 0.0
    counts = [0.0] * (1 << bits)
    for n in (1, 2, 3):
        for b in _gram_buckets(_letters(text), n, bits):
            counts[b] += 1
    norm = math.sqrt(sum(counts)) or 1.0
    x = [math.sqrt(c) / norm for c in counts] + [0.3]

    def winner(group, members):
        votes, sums, worst = dict.fromkeys(members, 0), dict.fromkeys(members, 0.0), dict.fromkeys(members, 1.0)
        for (g, a, b), w, s in zip(model.pairs, model.weights, model.slopes):
            if g == group:
                p = 1 / (1 + math.exp(-max(-40.0, min(40.0, s * sum(u * float(v) for u, v in zip(x, w) if u)))))
                for name, q, won in ((a, p, p >= 0.5), (b, 1 - p, p < 0.5)):
                    votes[name] += won
                    sums[name] += q
                    worst[name] = min(worst[name], q)
        best = min(members, key=lambda m: (-votes[m], -sums[m], members.index(m)))
        return best, worst[best]

    family, outer = winner("", model.families)
    name, inner = winner(family, model.languages[family])
    return name, outer * inner


def _shape(text):
    out, low = [], text.lower()
    for i, c in enumerate(text):
        if len(low) == len(text) and low[i] != c:
            k = 65
        elif ord(c) >= 128 or "a" <= c <= "z":
            k = 97
        elif "A" <= c <= "Z":
            k = 65
        else:
            k = 57 if c in "0123456789" else 32 if c in "\t\n\x0b\x0c\r" else ord(c)
        if not out or out[-1] != k:
            out.append(k)
    return out


def _word_buckets(data, bits):
    out = []
    for w in re.split(rb"[\x09-\x0D\x20]+", data):
        if w:
            h = 0
            for c in reversed(w):
                h = (h * 0x100000001B3 + c + 1) & _MASK
            out.append(_bucket(h, 31, bits))
    return out


def quality_score(text, model, bits):
    """The score by a plain forward pass: every word's and n-gram's vector is
    looked up and averaged, then the softmax layer."""
    dim = len(model.bias) and model.embeddings.shape[1]
    size = 1 << bits
    total = [{}, {}, {}]

    def add(kind, b, n=1):
        total[kind][b] = total[kind].get(b, 0) + n

    if text:
        data = b" " + text.encode() + b" "
        words = _word_buckets(data, bits)
        for b in words:
            add(0, b)
        for n in (2, 3, 4):
            for b in _gram_buckets(data, n, bits):
                add(1, b)
        for n in (3, 4, 6):
            for b in _gram_buckets(_shape(f" {text} "), n, bits):
                add(2, b)
        add(2, 0, 3 * sum(a == b for a, b in zip(words, words[1:])))
    v = [0.0] * dim
    for kind, counts in enumerate(total):
        n = max(1, sum(counts.values()))
        for b, c in counts.items():
            for j in range(dim):
                v[j] += c / n / 3 * float(model.embeddings[kind * size + b, j])
    z = [sum(v[j] * float(model.layer[j, c]) for j in range(dim)) + float(model.bias[c]) for c in (0, 1)]
    return 1 / (1 + math.exp(z[0] - z[1]))
