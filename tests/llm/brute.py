"""Plain Python versions of the corpus operators: slow, obvious, no Spark."""

import hashlib
import math
import re
import struct
import zlib
from collections import Counter
from itertools import pairwise

import public_tokenizers
import xxhash

from tidewright.llm import license_scan, secret_scan

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def remainder(doc_id, folds):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % folds


# Secrets

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)


def entropy(window):
    return -sum(n / len(window) * math.log2(n / len(window)) for n in Counter(window).values())


def base_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def spans(text):
    found = base_spans(text)
    for k, c in enumerate(secret_scan.CLASSES):
        for m in re.finditer("[" + re.escape(c.letters) + "]+", text):
            parts = re.split("[/=]", m[0]) if len(m[0]) >= c.window else []
            kept = "/".join("~" if any(re.search(a, x) for a in secret_scan.ALLOWED) else x for x in parts)
            for x in kept.split("~"):
                bits = c.bits if all(re.search(p, x) for p in c.mixed) else c.plain
                windows = [x[i : i + c.window] for i in range(len(x) - c.window + 1)]
                if bits is not None and any(entropy(w) >= bits - 1e-9 for w in windows):
                    found.append((m.start(), 3 + k, m.end()))
                    break
    return sorted(found)


def spelled(found):
    return ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in found)


def redacted(text):
    out, at = "", 0
    for a, _, b in spans(text):
        if a >= at:
            out += text[at:a] + secret_scan.MASK
        at = max(at, b)
    return out + text[at:]


# Quality rules


def statistics(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated)


def rules(rows):
    """rows: (text, source). (statistics, base_failed, kept) of each."""
    found = [statistics(t or "") for t, _ in rows]
    failed = [s[0] < 10 or 100 * s[4] > 20 * s[0] for s in found]
    bad = set()
    for rule in ([s[0] < 10 for s in found], [100 * s[4] > 20 * s[0] for s in found], failed):
        hosts = {}
        for (_, source), f in zip(rows, rule, strict=True):
            if source is not None:
                n = hosts.setdefault(source.lower(), [0, 0])
                n[0] += 1
                n[1] += f
        if not hosts:
            continue
        docs = sum(n for n, _ in hosts.values())
        mean, chance = sum(f for _, f in hosts.values()) / docs, len(hosts) / docs
        spread = sum(n * (f / n - mean) ** 2 for n, f in hosts.values()) / docs
        between = (spread - mean * (1 - mean) * chance) / (1 - chance) if chance < 1 else 0
        weight = min(1e6, max(2.0, mean * (1 - mean) / between - 1)) if between > 1e-12 else 1e6
        bad |= {h for h, (n, f) in hosts.items() if (f + mean * weight) / (n + weight) > 0.5}
    hosted = [s is not None and s.lower() in bad for _, s in rows]
    return [(s, f, not f and not h) for s, f, h in zip(found, failed, hosted, strict=True)]


# Near copies


def fingerprint(text):
    words = WORD.findall(text.translate(LOWER))
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(n, linked):
    """For n places, the smallest place reachable by links (pairs)."""
    near = {}
    for a, b in linked:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    out = [None] * n
    for i in range(n):
        if out[i] is None:
            todo = [i]
            while todo:
                x = todo.pop()
                if out[x] is None:
                    out[x] = i
                    todo += near.get(x, ())
    return out


def near_classes(prints, bits=3):
    n = len(prints)
    return roots(n, [(i, j) for i in range(n) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= bits])


# Benchmark


def leak_words(text):
    return re.findall(r"[^\W_]+", text.lower())


def leaks(text, items):
    """{item: best similarity} of at least 0.8, over all windows."""
    words, out = leak_words(text), {}
    for item, own in items:
        k = min(5, len(own))
        if not k:
            continue
        size = min(len(own), len(words))
        target = Counter(zip(*(own[i:] for i in range(k)), strict=False))
        if not target.keys() & set(zip(*(words[i:] for i in range(k)), strict=False)):
            continue  # nothing in common
        for s in range(len(words) - size + 1):
            window = Counter(zip(*(words[s + i : s + size] for i in range(k)), strict=False))
            both = sum((window & target).values())
            alike = both / sum((window | target).values())
            if alike >= 0.8 - 1e-12:
                out[item] = max(alike, out.get(item, 0))
    return out


# Licenses


def licenses(text):
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    out = {}
    for name, template in license_scan.TEMPLATES.items():
        own = [w for w in re.split(r"[\W_]+", template.lower()) if w]
        own = {tuple(own[i : i + 5]) for i in range(len(own) - 4)}
        n = len(own)
        best = None
        for a in range(len(grams)):
            held = len(own & set(grams[a : a + 2 * n])) / n
            if held >= 0.8:
                best = max(best or (0,), (held, a % n == 0, -a))
        if best:
            out[name] = best[0], -best[2]
    return out


# Token files


def token_rows(rows):
    """rows: (id, text) in order. (id, start, n_tokens, crc32)."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    at, out = 0, []
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((i, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    return out


# Language model


def lm_rows(rows, tokenizer):
    """rows: (id, text). (held_out, n_tokens, n_known, train_tokens, base_score, score) of each."""
    split = [(remainder(i, 7) == 2, WORD.findall((t or "").translate(LOWER))) for i, t in rows]
    counts, ends = Counter(), 0
    for held, words in split:
        if not held:
            counts.update(words)
            ends += 1
    total, distinct = counts.total() + ends, len(counts) + (ends > 0)
    pieces = Counter()
    for word, n in counts.items():
        for p in tokenizer.encode(word):
            pieces[p] += n
    size = tokenizer.get_piece_size()
    used = [i for i in range(size) if not (tokenizer.is_control(i) or tokenizer.is_unknown(i) or tokenizer.is_unused(i))]
    mass = sum(pieces[i] + 1 for i in used) + ends + 1
    chance = {tokenizer.id_to_piece(i): (pieces[i] + 1) / mass for i in used if not tokenizer.is_byte(i)}
    byte = {int(tokenizer.id_to_piece(i)[3:5], 16): (pieces[i] + 1) / mass for i in used if tokenizer.is_byte(i)}
    known = {}

    def marginal(word):
        if word not in known:
            text = "▁" + word
            logs = [0.0]
            for j in range(1, len(text) + 1):
                ways = [logs[i] + math.log(chance[text[i:j]]) for i in range(max(0, j - 16), j) if text[i:j] in chance]
                ways.append(logs[-1] + sum(math.log(byte[b]) for b in text[j - 1].encode()))
                logs.append(max(ways) + math.log(math.fsum(math.exp(w - max(ways)) for w in ways)))
            known[word] = logs[-1] / math.log(10)
        return known[word]

    out = []
    for held, words in split:
        base = [math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words]
        base.append(math.log10((ends + 1) / (total + distinct + 1)))
        score = math.fsum(map(marginal, words)) + math.log10((ends + 1) / mass)
        out.append((held, len(words) + 1, sum(w in counts for w in words) + (ends > 0), total, math.fsum(base), score))
    return out


def chain(n):
    return list(pairwise(range(n)))


# Token alignment


def aligned(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_overlaps) of each text."""
    import sentencepiece
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in visible}
    letters.update({chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in visible)})

    def ends(parts):
        out = [0]
        for p in parts:
            out.append(out[-1] + len(p))
        return out

    rows, counts = [], Counter()
    for text in texts:
        text = text or ""
        a, b = (tokenizer.encode(" " + text, add_special_tokens=False).ids, model.encode(text)) if text else ([], [])
        a_parts = [bytes(letters[c] for c in tokenizer.id_to_token(i)) for i in a]
        b_parts = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode() for i in b]
        raw = (" " + text).encode()
        if not text or b"".join(a_parts) != raw or b"".join(b_parts) != raw:
            rows.append(([], [], [], 0))
            continue
        a_ends, b_ends = ends(a_parts), ends(b_parts)
        common = sorted(set(a_ends) & set(b_ends))
        groups = []
        for x, y in pairwise(common):
            groups.append(([i for i, e in zip(a, a_ends[1:], strict=True) if x < e <= y], [i for i, e in zip(b, b_ends[1:], strict=True) if x < e <= y]))
        links = [(g[0][-1], g[1][-1]) for g in groups]
        shared = sum(s < v and u < e for s, e in pairwise(a_ends) for u, v in pairwise(b_ends)) if len(raw) < 3000 else None
        counts.update(links)
        rows.append((a, b, groups, shared))
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    out = []
    for a, b, groups, shared in rows:
        links = [(g[0][-1], g[1][-1]) for g in groups]
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(said.encode()).hexdigest() if groups else ""
        n_best = sum(counts[k] == best[k[1]] for k in links)
        out.append((len(a), len(b), len(groups), len(links), n_best, sum(counts[k] for k in links), digest, shared))
    return out


# Language and quality


def language_buckets(text):
    """Hashed 1- to 3-grams of the letters of a text, runs of anything else being one blank."""
    letters = re.sub(" +", " ", "".join(c if c.isalpha() else " " for c in f" {text.lower()} "))
    out = []
    for order in (1, 2, 3):
        for i in range(len(letters) - order + 1):
            gram = letters[i : i + order]
            if gram == " ":
                continue
            code = order * 0x27D4EB2F
            for c, factor in zip(gram, (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D), strict=False):
                code += ord(c) * factor
            code &= 0xFFFFFFFF
            code ^= code >> 15
            out.append((code * 0x2C1B3C6D & 0xFFFFFFFF) >> 16)
    return out


def languages(rows):
    """rows: (id, text, lang). (prediction, score) of each."""
    counts, docs = {}, Counter()
    for i, text, lang in rows:
        if lang is not None and remainder(i, 3) != 1:
            counts.setdefault(lang, Counter()).update(language_buckets(text or ""))
            docs[lang] += 1
    out = []
    for _, text, _ in rows:
        if not counts or not any(c.isalpha() for c in text or ""):
            out.append(("und", 0.0))
            continue
        logs = {}
        for lang, own in counts.items():
            total = own.total() + 0.1 * 65536
            prior = math.log((docs[lang] + 1) / (docs.total() + len(docs)))
            logs[lang] = prior + math.fsum(math.log((own[b] + 0.1) / total) for b in language_buckets(text))
        top = max(logs.values())
        mass = math.fsum(math.exp(x - top) for x in logs.values())
        best = min(lang for lang, x in logs.items() if x == top)
        out.append((best, 1 / mass))
    return out


def quality_features(texts):
    """The three pools of each text, word by word."""
    import numpy as np

    from tidewright.llm import quality_model as q

    split = [[(zlib.crc32(w) >> 5) % q.BUCKETS for w in re.findall(rb"[A-Za-z\x80-\xff]+|[^A-Za-z\x80-\xff\s]+", (t or "").encode())] for t in texts]
    places, signs = q.index_vectors()
    sums, seen = {}, Counter()
    for words in split:
        seen.update(words)
        for i, word in enumerate(words):
            own = sums.setdefault(word, [0.0] * q.SIZE)
            for j in (i - 2, i - 1, i + 1, i + 2):
                if 0 <= j < len(words):
                    for at, sign in zip(places[words[j]], signs[words[j]], strict=True):
                        own[at] += sign
    vectors = {w: np.array(v) / max(1.0, math.sqrt(sum(x * x for x in v))) for w, v in sums.items()}
    weight = {w: 1e-3 / (1e-3 + n / seen.total()) for w, n in seen.items()}
    out = []
    for words in split:
        pools = np.zeros((3, q.SIZE))
        for i, w in enumerate(words):
            pools[0] += vectors[w] / len(words)
            pools[1] += vectors[w] * weight[w]
            if i:
                pools[2] += vectors[w] * vectors[words[i - 1]] / (len(words) - 1)
        if words:
            pools[1] /= sum(weight[w] for w in words)
        out.append(pools.ravel())
    return out


# Fingerprints


def sketch(text):
    words = WORD.findall((text or "").translate(LOWER))
    grams = {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    hashes = sorted(hashlib.md5(g.encode()).hexdigest()[:16] for g in grams)
    return [h for h in hashes if h < "2"] or hashes[:1]


def fingerprints(rows):
    """rows: (id, text). (id, n_chars, edited hash, fingerprint, edited fingerprint, likenesses, shares) of each."""

    def alike(a, b):
        return len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 1.0

    def inside(a, b):
        return len(set(a) & set(b)) / len(a) if a else 1.0

    def place(row):
        h = xxhash.xxh64((row[1] or "").encode(), seed=42).intdigest()
        return row[0] is None, -(row[0] or 0), h - (1 << 64 if h >> 63 else 0)

    rows = sorted(rows, key=place)
    out = []
    for (i, t), (_, u) in zip(rows, rows[1:] + rows[:1], strict=True):
        t, u = t or "", u or ""
        third = len(t) // 3
        e = t[: len(t) - third] + u[:third]
        a, c, z = sketch(t), sketch(e), sketch(u)
        near = (alike(a, c), alike(a, z), inside(a, c), inside(a, z))
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), "".join(a), "".join(c), *(round(x, 9) for x in near)))
    return out


# Collocations


def collocations(rows, least, top):
    """rows: (lang, text). (lang, rank, phrase, a, l, r, n, score)."""
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            own = counts.setdefault(lang, Counter())
            for n in (1, 2, 3):
                own.update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and p in (q[:2], q[1:]) and 100 * b >= 50 * a for q, b in candidates.items()):
                continue
            score, _, left, right = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return out
