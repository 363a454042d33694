"""Plain versions of the operators, for small tables."""

import hashlib
import re
from collections import defaultdict

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def kept_words(rows):
    """``(n_words, n_removed, sha256)`` by (doc_id, text); null ids last."""
    seen, found = set(), {}
    for doc_id, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        words = WORDS.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(window)
        kept = [w for w, g in zip(words, gone, strict=True) if not g]
        found[doc_id, text] = len(words), len(words) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()
    return found


def shingles(text):
    words = WORDS.findall((text or "").translate(LOWER))
    k = min(5, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else frozenset()


def components(rows, percent=85):
    """``(n_shingles, component_id)`` by (doc_id, text), all pairs compared."""
    rows = list(dict.fromkeys(rows))
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(i)
    found = {}
    for group in members.values():
        ids = [rows[i][0] for i in group if rows[i][0] is not None]
        for i in group:
            found[rows[i]] = len(sets[i]), min(ids, default=None)
    return found


def alignments(rows, a_path, b_path):
    """The row of each (doc_id, text), every link listed: byte by byte over whole texts."""
    import sentencepiece
    from tokenizers import Tokenizer

    import json

    tokenizer, processor = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
    tokenizer.encode_special_tokens = True
    with open(a_path, encoding="utf-8") as file:
        vocabulary = {i: e for e, i in json.load(file)["model"]["vocab"].items()}
    # The byte-level alphabet, from what the library makes of each character's bytes.
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    letter = {chr(b): b for b in visible}
    letter.update({chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in visible)})
    found, corpus = [], defaultdict(int)
    for doc_id, text in rows:
        links, groups = [], []
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
        b = processor.encode(text) if text else []
        bytes_a = [bytes(letter[c] for c in vocabulary[i]) for i in a]
        bytes_b = [bytes([int(processor.id_to_piece(i)[3:5], 16)]) if processor.is_byte(i) else processor.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            a, b = [], []
        else:
            at_a = [n for n, e in enumerate(bytes_a) for _ in e]
            at_b = [n for n, e in enumerate(bytes_b) for _ in e]
            links = [(a[i], b[j]) for i, j in sorted(set(zip(at_a, at_b, strict=True)))]
            start = 0
            for n in range(1, len(at_a) + 1):
                if n == len(at_a) or (at_a[n] != at_a[n - 1] and at_b[n] != at_b[n - 1]):
                    groups.append((sorted(set(at_a[start:n])), sorted(set(at_b[start:n]))))
                    start = n
        for link in links:
            corpus[link] += 1
        text_of = ";".join(",".join(str(a[i]) for i in x) + "|" + ",".join(str(b[i]) for i in y) for x, y in groups)
        found.append((doc_id, len(a), len(b), links, len(groups), hashlib.sha256(text_of.encode()).hexdigest() if a else ""))
    best = defaultdict(int)
    for (_, b), n in corpus.items():
        best[b] = max(best[b], n)
    return [
        (doc_id, n_a, n_b, n_groups, len(links), sum(corpus[x] == best[x[1]] for x in links), sum(corpus[x] for x in links), sha)
        for doc_id, n_a, n_b, links, n_groups, sha in found
    ]


def trie(rows):
    """Rows of the prefix trie of (conv_id, turn, role, text), by dictionaries of whole prefixes."""
    import zlib

    def order(row):
        role, text = row[2] or "", row[3] or ""
        whole = f"{len(role.encode())}:{role}{text}".encode()
        return (row[1] is not None, row[1] or 0, hashlib.sha256(whole).digest()[:16], len(text.encode()))

    own = defaultdict(list)
    for row in sorted((r for r in rows if r[0] is not None), key=order):
        own[row[0]].append((row[2] or "", row[3] or ""))
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        whole = (*own.get(base, [])[:h], *turns[h:])
        ends[whole].append(c)
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[c] for c in children[p]) or 1
        saved[p] = (len(members[p]) - 1) * len(p[-1][1].encode() if p else b"") + sum(saved[c] for c in children[p])
    return [
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, m in members.items()
    ]
