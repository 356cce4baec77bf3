"""Edge-case documents, and plain reference versions of the operators."""

import collections
import hashlib
import math
import re
import zlib

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words int, kept string, component int, start int, _x int"
LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(30_000))
PASSAGE = " ".join(f"passage{i}of{i * 7 % 31}" for i in range(70))
TEXTS = [
    None, "", " ", "\n\t \n", "a", "The end", "The end", "été À la Plage, 42 fois... l'été!", "中文 字 😀 ﬁ x² ½ Ǆ İstanbul ẞ",
    "<|endoftext|> and <|startoftext|> in a text <|endoftext|>", "don't we'll I'm she'd they've it's 'S", "x" * 5000, LONG,
    "one two three four five six seven eight nine ten eleven " + PASSAGE + " tail of the first document here",
    "quite another head, with words of its own before it. " + PASSAGE + " and one more ending",
    "mail a.b+c@mail.example.com or +1 (988) 555-2485, ip 10.0.0.255 and 999.1.2.3, card 4111 1111 1111 1111 end",
    "a@b.c_d@e.f 1.2.3.4.5.6.7.8 4111-1111-1111-1111 4111 1111  1111 1111 +12345 0+1 234 567 8901",
    "12345678901234567890 5500005555555559 é@é.com x@y 1.2.3 ++1 22 33 44 55 66 77", "\x00\x85\xa0 　z", "ab\r\ncd\r\nab\r\ncd\r\n",
    "▁ ▁▁ word ▁word  word", "the cat sat on the mat " * 30, "line\nline\nline\nother line here\n" * 5,
]


def rows():
    out = [(i, t, "en" if i % 3 else "fr", f"s{i % 2}", len(t or ""), 7, "k", 1, 2, 3) for i, t in enumerate(TEXTS)]
    out += [out[5], out[5], out[12]]  # repeated rows
    out += [(None, "a text without an id, but with some words of its own", "en", None, 1, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None)]
    return out


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def base_quality(text):
    t, w = text or "", words(text)
    windows = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {k for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for k in range(i, i + 5)}
    lines = [x for x in t.split("\n") if words(x)]
    n, r = len(w), len(covered)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), r, n < 10 or 100 * r > 20 * n


def simhash(text):
    from xxhash import xxh64_intdigest

    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def linked(prints, ids):
    """Smallest id reachable for each document."""
    up = list(range(len(prints)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                up[max(root(a), root(b))] = min(root(a), root(b))
    best = {}
    for i, d in enumerate(ids):
        if d is not None:
            best[root(i)] = min(best.get(root(i), d), d)
    return [best.get(root(i)) for i in range(len(ids))]


def _luhn(s):
    d = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(s))]
    return sum(x - 9 if x > 9 else x for x in d) % 10 == 0


KINDS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v, d: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v, d: all(int(x) <= 255 for x in v.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda v, d: 14 <= len(d) <= 19 and _luhn(d)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda v, d: 10 <= len(d) <= 15),
}


def private(text):
    """(counts by kind, sha256 of the spans)."""
    found = []
    for n, (kind, (pattern, good)) in enumerate(KINDS.items()):
        found += [(m.start(), n, m.end(), kind) for m in re.finditer(pattern, text or "") if good(m[0], re.sub(r"\D", "", m[0]))]
    listed = ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))
    return [sum(f[3] == k for f in found) for k in KINDS], hashlib.sha256(listed.encode()).hexdigest()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def least_bins(lengths, capacity):
    return math.ceil(sum(lengths) / capacity)
