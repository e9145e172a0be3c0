"""Plain versions of the text operators, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {i: i + 32 for i in range(65, 91)}


def signed(h):
    return h - 2**64 if h >> 63 else h


def crc(key):
    return zlib.crc32(("" if key is None else str(key)).encode())


def base_quality(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    many, covered = Counter(grams), set()
    for i, gram in enumerate(grams):
        if many[gram] > 1:
            covered.update(range(i, i + 5))
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed,
    )


def js_distance(a, b):
    n, m = sum(a), sum(b)
    if not n or not m:
        return 0.0
    total = 0.0
    for x, y in zip(a, b):
        p, q = x / n, y / m
        total += (p * math.log2(2 * p / (p + q)) if p else 0) + (q * math.log2(2 * q / (p + q)) if q else 0)
    return math.sqrt(max(0.0, total / 2))


def char_histogram(text):
    import regex

    from pricewright.llm.quality import CHAR_CLASSES

    counts = [len(regex.findall(p, text)) for p in CHAR_CLASSES.values()]
    counts.append(len(text) - sum(map(len, WORD.findall(text))))
    return [*counts, len(text) - sum(counts)]


def word_histogram(text, lang):
    from pricewright.llm.quality import ANY_LANGUAGE, COMMON_WORDS

    words = WORD.findall(text)
    counts = [words.count(w) for w in COMMON_WORDS.get(lang, ANY_LANGUAGE)]
    return [*counts, len(words) - sum(counts)]


def quality_kept(docs):
    """kept of each (doc_id, text, lang), in order."""
    from pricewright.llm import quality as q

    hists = [(char_histogram(t or ""), word_histogram(t or "", lang)) for _, t, lang in docs]
    refs = {}
    for (_, _, lang), (c, w) in zip(docs, hists):
        if sum(c) >= q.GUARD_CHARS and sum(w) >= q.GUARD_WORDS:
            have = refs.setdefault(lang, ([0] * len(c), [0] * len(w)))
            refs[lang] = tuple([x + y for x, y in zip(a, b)] for a, b in zip(have, (c, w)))
    for lang, (c, w) in refs.items():
        if js_distance(c, q.PROSE_CHARS) > q.MAX_REFERENCE_DISTANCE:
            c = q.PROSE_CHARS
        if lang in q.COMMON_WORDS and 100 * sum(w[:-1]) < q.MIN_COMMON_PERCENT * sum(w):
            w = q.PROSE_WORDS
        refs[lang] = (c, w)
    kept = []
    for (_, text, lang), (c, w) in zip(docs, hists):
        near = True
        if lang in refs:
            near = (sum(c) < q.GUARD_CHARS or js_distance(c, refs[lang][0]) <= q.MAX_CHAR_DISTANCE) and (
                sum(w) < q.GUARD_WORDS or js_distance(w, refs[lang][1]) <= q.MAX_WORD_DISTANCE
            )
        kept.append(near and not base_quality(text)[-1])
    return kept


def chunks_of(lines):
    """First lines of the two-line chunks of all chunkings: a bit set in the hash of the first line and not of the second."""
    hashes = [xxhash.xxh64_intdigest(line.encode(), 42) for line in lines]
    return [i for i in range(len(lines) - 1) if hashes[i] & ~hashes[i + 1] & 0xFF]


def line_dedup(docs, reach=2):
    """[(doc_id, text)] -> texts without repeated passages, and the dropped lines."""
    seen, texts = defaultdict(set), {}
    for key, text in docs:
        lines = (text or "").split("\n")
        fold = signed(xxhash.xxh64_intdigest((text or "").encode(), 42))
        texts[(key is None, key or 0, fold)] = lines
        for s in chunks_of(lines):
            if WORD.search(lines[s]) or WORD.search(lines[s + 1]):
                seen[tuple(lines[s : s + 2])].add((key is None, key or 0, fold, s))
    out = []
    for key, text in docs:
        lines = (text or "").split("\n")
        fold = signed(xxhash.xxh64_intdigest((text or "").encode(), 42))
        gone = set()
        for s in chunks_of(lines):
            places = seen.get(tuple(lines[s : s + 2]), ())
            if not places or min(places) == (key is None, key or 0, fold, s):
                continue
            *owner, at = min(places)
            kept = texts[tuple(owner)]
            gone |= {s, s + 1}
            for step, own, its in ((-1, s - 1, at - 1), (1, s + 2, at + 2)):
                for _ in range(reach):
                    if not (0 <= own < len(lines) and 0 <= its < len(kept) and lines[own] == kept[its]):
                        break
                    gone.add(own)
                    own, its = own + step, its + step
        kept = "\n".join(line for i, line in enumerate(lines) if i not in gone)
        out.append((None if text is None else kept, sorted(gone)))
    return out


def mixing(docs):
    """[(doc_id, source, text)] -> {row index: (size, source size, target, passes)}; targets by repeated resharing."""
    sizes = [len(WORD.findall(t or "")) for _, _, t in docs]
    sources = defaultdict(int)
    for (_, source, _), n in zip(docs, sizes):
        sources[source] += n
    order = sorted((s for s in sources if s is not None), key=lambda s: s.encode()) + [None] * (None in sources)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    whole, targets, free = sum(sizes), {}, set(order)
    while free:
        left = whole - sum(targets.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] >= 3 * sources[s]}
        if not above:
            targets.update(share)
            break
        targets.update({s: 3 * sources[s] for s in above})
        free -= above
    result = {}
    for s in order:
        own = [i for i, d in enumerate(docs) if d[1] == s]
        own.sort(key=lambda i: (hashlib.md5(("" if docs[i][0] is None else str(docs[i][0])).encode()).hexdigest(), docs[i][0] is not None, docs[i][0] or 0, sizes[i]))
        full = int(targets[s] // sources[s]) if sources[s] else 0
        rest, before = targets[s] - full * sources[s], 0
        for i in own:
            extra = 2 * before + sizes[i] <= 2 * rest
            result[i] = (sizes[i], sources[s], targets[s], full + extra if sizes[i] else 0, before)
            before += sizes[i]
    return result
