"""Plain single-machine versions of the operators' contracts, to compare with."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def folded(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def secrets(text):
    """Counts of assign, access and hex, and the digest of their spans."""
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    names = ("assign", "access", "hex")
    joined = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(spans))
    return (*[sum(k == i for _, k, _ in spans) for i in range(3)], sha(joined))


def clusters(links, nodes):
    """Smallest node reachable from each."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, size):
    words = WORD.findall(folded(text or ""))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def jaccard(docs, size=3, percent=90):
    """``docs`` of (id, text) with distinct ids: id to (set size, component)."""
    sets = {i: shingles(t, size) for i, t in docs}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    shared = Counter((a, b) for ids in holders.values() if len(ids) < 5000 for a in ids for b in ids if a < b)
    links = [(a, b) for (a, b), n in shared.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]
    root = clusters(links, sets)
    return {i: (len(s), root[i]) for i, s in sets.items()}


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """``sizes`` by source: targets by resharing the excess until no source is above its limit."""
    order = sorted([s for s in sizes if s is not None], key=lambda s: s.encode("utf-32-be")) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, free, budget = {}, set(order), share * sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if budget * weight[s] / total > most * sizes[s]]
        if not over:
            out |= {s: budget * weight[s] / total for s in free}
            break
        for s in over:
            out[s] = most * sizes[s]
            budget -= out[s]
            free.discard(s)
    return out


def quality(text):
    words = WORD.findall(text or "")
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def repeats(docs, size=50):
    """``docs`` of (id, text): id to (words, removed words, digest of the kept)."""
    words = {i: WORD.findall(t or "") for i, t in docs}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - size + 1):
            first.setdefault(tuple(words[i][k : k + size]), i)
    out = {}
    for i, w in words.items():
        gone = {k + d for k in range(len(w) - size + 1) if first[tuple(w[k : k + size])] < i for d in range(size)}
        out[i] = (len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def licenses(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded(text or ""))
    found = [(i, label) for phrase, label in PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in found]
    return len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))


def merkle(docs):
    """``docs`` of (doc_id, text, lang, source, n_chars): sorted rows of the manifest's contract, and the root."""

    def leaf(row, more=0):
        key, text, lang, source, n = row
        fields = [key, source, lang, None if n is None else n + more, text]
        return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))

    def tree(level):
        """Root, and for each leaf its siblings as (left, right), upwards."""
        members, paths = [[i] for i in range(len(level))], [[] for _ in level]
        while len(level) > 1:
            runs = [(level[i : i + 2], members[i : i + 2]) for i in range(0, len(level), 2)]
            for run, below in runs:
                for k, held in enumerate(below):
                    for i in held:
                        paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            level, members = [sha("".join(run)) for run, _ in runs], [sum(below, []) for _, below in runs]
        return (level or [None])[0], paths

    groups = defaultdict(list)
    for row in docs:
        groups[row[2]].append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    grown = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        grown[g] = tree([leaf(r) for r in groups[g]])
    root, tops = tree([grown[g][0] for g in order])
    out = []
    for g, top in zip(order, tops, strict=True):
        subroot, paths = grown[g]
        for row, path in zip(groups[g], paths, strict=True):
            node = leaf(row, int(row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0))
            for left, right in path + top:
                node = sha(left + node + right)
            out.append((row[0], leaf(row), subroot, root, sha("".join(a + b for a, b in path + top)), node, node == root))
    return sorted(out, key=str)


class Tokenizers:
    """Both tokenizers over whole texts, and the bytes of their ids."""

    def __init__(self, json_a, model_b):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(json_a), sentencepiece.SentencePieceProcessor(model_file=model_b)
        self.a.encode_special_tokens = True
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in own]
        back = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}
        self.bytes_a = {i: bytes(back[c] for c in t) for t, i in self.a.get_vocab().items() if all(c in back for c in t)}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("\u2581", " ").encode() for i, p in enumerate(pieces)]

    def encode(self, text):
        """Ids of A and of B, or none if they do not give the text back."""
        if not text:
            return [], []
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        whole = (" " + text).encode()
        if b"".join(self.bytes_a[i] for i in a) != whole or b"".join(self.bytes_b[i] for i in b) != whole:
            return [], []
        return a, b


def merged(ends_a, ends_b):
    """Groups as (from, to, from, to) and links as (i, j), token by token."""
    i = j = p = q = 0
    groups, links = [], []
    while i < len(ends_a):
        links.append((i, j))
        end = ends_a[i] - ends_b[j]
        i, j = i + (end <= 0), j + (end >= 0)
        if end == 0:
            groups.append((p, i, q, j))
            p, q = i, j
    return groups, links


def alignment(docs, tokenizers):
    """``docs`` of (id, text): rows of the alignment's contract."""
    found, counts = [], Counter()
    for key, text in docs:
        a, b = tokenizers.encode(text)
        ends = [_ends(table, ids) for table, ids in ((tokenizers.bytes_a, a), (tokenizers.bytes_b, b))]
        groups, links = merged(*ends)
        pairs = [(a[i], b[j]) for i, j in links]
        counts.update(pairs)
        shown = ";".join(",".join(map(str, a[p:x])) + "|" + ",".join(map(str, b[q:y])) for p, x, q, y in groups)
        found.append((key, len(a), len(b), len(groups), pairs, shown))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return [
        (key, n_a, n_b, n_groups, len(pairs), sum(counts[p] == best[p[1]] for p in pairs), sum(counts[p] for p in pairs), sha(shown) if n_a else "")
        for key, n_a, n_b, n_groups, pairs, shown in found
    ]


def _ends(table, ids):
    out, at = [], 0
    for i in ids:
        at += len(table[i])
        out.append(at)
    return out
