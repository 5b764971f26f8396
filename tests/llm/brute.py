"""Plain single-process versions of the operators' contracts, for small inputs."""

import base64
import hashlib
import re
import zlib
from collections import defaultdict

import public_tokenizers as P

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode("utf-8") if isinstance(text, str) else text).hexdigest()


def contamination(docs, items, window=13):
    """docs, items: lists of (id, text). Rows: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))

    grams = defaultdict(set)
    for item, text in items:
        w = words(text)
        if w:
            size = min(window, len(w))
            for k in range(len(w) - size + 1):
                grams[tuple(w[k:k + size])].add(item)
    sizes = {len(g) for g in grams}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                g = tuple(w[k:k + size])
                if g in grams:
                    hit.update(range(k, k + size))
                    found |= grams[g]
        out.append((doc, len(w), len(hit), len(found), sha(",".join(sorted(map(str, found)))),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return out


def near_duplicates(docs, shingle=3, threshold=85):
    """Rows: doc_id, n_shingles, component_id, kept."""
    sets = []
    for _, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets.append({tuple(w[k:k + shingle]) for k in range(max(1, len(w) - shingle + 1))} if w else set())
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    where = defaultdict(list)
    for i, s in enumerate(sets):
        shared = defaultdict(int)
        for g in s:
            for j in where[g]:
                shared[j] += 1
            where[g].append(i)
        for j, n in shared.items():
            if 100 * n >= threshold * (len(s) + len(sets[j]) - n):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        least[root(i)] = min(least.get(root(i), doc), doc)
    return [(doc, len(sets[i]), least[root(i)], doc == least[root(i)]) for i, (doc, _) in enumerate(docs)]


def token_files(docs):
    """Rows: doc_id, start, n_tokens, ids_crc32."""
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    out, start = [], 0
    for doc, text in sorted(docs, key=lambda d: d[0]):
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    return out


def rank_encoder(name="byte_bpe_multi_50k.tiktoken"):
    import tiktoken
    with open(P.path(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def bpe(docs):
    """Rows: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    e = rank_encoder()
    out = []
    for doc, text in docs:
        ids = e.encode_ordinary(text or "")
        out.append((doc, len(ids), sha(",".join(map(str, ids))), sha(text or "")))
    return out


def secrets_base(text):
    """(n_assign, n_access, n_hex, spans) of a text; spans as (kind, start, end) in order."""
    text = text or ""
    found = []
    pattern = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(pattern, text, re.ASCII):
        if len(m[2]) >= 12:
            found.append(("assign", m.start(), m.end()))
    found += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    order = ["assign", "access", "hex"]
    found.sort(key=lambda s: (s[1], order.index(s[0])))
    return *(sum(s[0] == k for s in found) for k in order), found


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = defaultdict(list)
    for k in range(len(w) - 4):
        windows[tuple(w[k:k + 5])].append(k)
    repeat = {p for places in windows.values() if len(places) > 1 for k in places for p in range(k, k + 5)}
    n = len(w)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeat),
            n < 10 or 100 * len(repeat) > 20 * n)


URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def url_rule(url):
    """host, path, the fitting rule and its verdict (or None, None)."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = host.translate(LOWER)
    fits = [(h, p, v) for h, p, v in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return host, path, None, None
    h, p, v = max(fits, key=lambda r: len(r[0] + r[1]))
    return host, path, h + p, v


def quality_kept(text, rules, stop_words):
    """The verdict of the threshold table on one text."""
    text = text or ""
    n, chars, symbols, dup_lines, _, failed = quality(text)
    if failed:
        return False
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    stop = {x for words in stop_words.values() for x in words}
    values = {
        "n_words": n, "mean_word_chars": chars / n, "symbol_ratio": symbols / n, "dup_line_ratio": dup_lines / len(lines),
        "stop_ratio": sum(x.lower() in stop for x in w) / n,
        "shout_ratio": sum(len(x) > 1 and x == x.upper() and x != x.lower() for x in w) / n,
        "ellipsis_line_ratio": sum(x.rstrip(" ").endswith(("...", "…")) for x in lines) / len(lines),
        "bullet_line_ratio": sum(x.lstrip(" ").startswith(("- ", "* ", "• ")) for x in lines) / len(lines)}
    return not any(n >= r.from_words and ((r.least is not None and values[r.measure] < r.least)
                                          or (r.most is not None and values[r.measure] > r.most)) for r in rules)
