"""Plain versions of what the operators compute, and rows that are easily mishandled."""

import collections
import re

import numpy as np
import xxhash

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row_id string, size string, fp int"

#: Null identifier and text, empty and blank text, repeated rows, ties, text with
#: many scripts; the last three columns clash with names the operators use.
ODD = [
    (None, None), (None, None), (1, ""), (1, ""), (2, None), (3, " \n\t "), (4, "Same Text here"), (5, "same text HERE"),
    (5, "same text HERE"), (-7, "sAme text here"), (6, "é€😀 日本 ÀÉ ñ ß"), (7, "É€😀 日本 ÀÉ ñ ß"), (8, "one"), (9, "one two"),
    (10, "mail a.b@c.de, ip 10.0.0.1. card 4111 1111 1111 1111; phone +1 (988) 555-2485!"),
    (11, "word " * 4000), (12, "x" * 30000), (13, "a\nb\na\n\nb\n  \n  \na b c d a b c"),
]


def documents(spark, rows):
    full = [(i, t, "en", "s", None if t is None else len(t), "r", "s", 1) for i, t in rows]
    return spark.createDataFrame(full, DOCS)


def lower_az(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def simhash(text):
    w = words_of(lower_az(text))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fingerprints, distance=3):
    """Root of each distinct fingerprint in the graph of links."""
    values = sorted(set(fingerprints))
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    for k, a in enumerate(values):
        for b in values[k + 1:]:
            if bin(a ^ b).count("1") <= distance:
                parent[find(b)] = find(a)
    return {v: find(v) for v in values}


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def pii_spans(text):
    def fine(kind, found):
        digits = re.sub("[^0-9]", "", found)
        if kind == "ip":
            return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))
        if kind == "card":
            return 14 <= len(digits) <= 19 and luhn(digits)
        return kind == "email" or 10 <= len(digits) <= 15

    spans = [(m.start(), n, m.end(), kind) for n, (kind, p) in enumerate(PII.items())
             for m in re.finditer(p, text or "") if fine(kind, m[0])]
    return sorted(spans)


def quality_counts(text):
    w = words_of(text)
    windows = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i, g in enumerate(zip(w, w[1:], w[2:])) if windows[g] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


def ids_of(texts, end=None):
    """Raw little-endian ids by the library, whole texts."""
    found = library().encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [np.array(e.ids + ([] if end is None else [end]), dtype="<u4").tobytes() for e in found]
