"""Slow and plain versions of the operators, and awkward documents to try them on."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections import Counter, defaultdict

MASK = (1 << 64) - 1
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def mix(x: int) -> int:
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def word_hash(word: bytes) -> int:
    h, up = 0, 1
    for b in word:
        h = (h + (b + 1) * up) & MASK
        up = up * 0x9E3779B97F4A7C15 & MASK
    return mix((h + len(word)) & MASK)


def tokens(text: str | None) -> list[str]:
    return [t for t in re.split("[ \t\n\r]+", text or "") if t]


def folded_words(text: str | None) -> list[bytes]:
    low = "".join(c.lower() if c.isascii() or (0xC0 <= ord(c) <= 0xDE and c != "×") else c for c in text or "")
    return [w.encode() for w in re.findall("[\u3000-\U0010ffff]|[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f\u3000-\U0010ffff]+", low)]


def fingerprint(text: str | None) -> int | None:
    words = folded_words(text)
    if not words:
        return None
    count = Counter(words)
    if len(count) < 5:
        own, up = len(words), 1
        for w in words:
            own = (own + word_hash(w) * up) & MASK
            up = up * 0xD6E8FEB86659FD93 & MASK
        own = mix(own)
        both = [mix(own), mix(own ^ 0xA0761D6478BD642F)]
    else:
        votes, total = [0] * 128, 0
        for w, n in count.items():
            weight = int(2 * len(w) * math.sqrt(n))
            h = word_hash(w)
            raw = h.to_bytes(8, "little") + mix(h ^ 0xA0761D6478BD642F).to_bytes(8, "little")
            for i in range(128):
                votes[i] += weight * (raw[i // 8] >> (7 - i % 8) & 1)
            total += weight
        raw = bytes(sum((2 * votes[8 * b + i] > total) << (7 - i) for i in range(8)) for b in range(16))
        both = [int.from_bytes(raw[:8], "little"), int.from_bytes(raw[8:], "little")]
    return both[0] << 64 | both[1]


def groups(nodes: list, linked) -> list[list]:
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(nodes, 2):
        if linked(a, b):
            root[find(b)] = find(a)
    out = defaultdict(list)
    for n in nodes:
        out[find(n)].append(n)
    return list(out.values())


def near_groups(docs: list[tuple], distance: int = 24) -> list[tuple]:
    """(least id, size) of each group; docs: (id, text)."""
    prints = [fingerprint(t) for _, t in docs]
    found = groups(list(range(len(docs))), lambda a, b: prints[a] is not None and prints[b] is not None and (prints[a] ^ prints[b]).bit_count() <= distance)
    key = lambda i: -(2**63) if docs[i][0] is None else docs[i][0]
    return sorted((min(map(key, g)), len(g)) for g in found)


def repeats(docs: list[tuple], width: int) -> set[tuple]:
    seen = Counter(tuple(w[i : i + width]) for _, t in docs for w in [tokens(t)] for i in range(len(w) - width + 1))
    hit = defaultdict(set)
    for id_, t in docs:
        w = tokens(t)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                hit[id_].add(i)
    out = set()
    for id_, at in hit.items():
        run = None
        for i in sorted(at):
            if run and i <= run[1]:
                run[1] = i + width
            else:
                if run:
                    out.add((id_, *run))
                run = [i, i + width]
        out.add((id_, *run))
    return {r for r in out if r[0] is not None}


def best_fit_bins(sizes: list[int], capacity: int) -> list[list[int]]:
    bins: list[list[int]] = []
    for s in sorted(sizes, reverse=True):
        fits = [b for b in bins if sum(b) + s <= capacity]
        if fits:
            max(fits, key=sum).append(s)
        else:
            bins.append([s])
    return bins


def line_templates(docs: list[tuple], leading: int, alike: float, least: int) -> set[tuple]:
    """(id, line number, documents of its template)."""
    from tramline.llm.line_dedup import FIELD

    lines = []
    for id_, t in docs:
        for no, raw in enumerate((t or "").split("\n")):
            line = re.sub("[0-9]+", FIELD, raw.strip(" \t\r"))
            if line:
                lines.append((id_, no, line))
    leaves = defaultdict(set)
    for _, _, line in lines:
        words = tuple(re.split("[ \t\r]+", line))
        leaves[len(words), words[:leading]].add(line)
    template = {}
    for leaf, members in leaves.items():
        made: list[list[str]] = []
        for line in sorted(members):
            words = re.split("[ \t\r]+", line)
            same = [sum(a == b for a, b in zip(m, words)) for m in made]
            best = max(range(len(made)), key=lambda i: (same[i], -i), default=None)
            if best is not None and same[best] >= alike * len(words):
                made[best] = [a if a == b else FIELD for a, b in zip(made[best], words)]
                template[line] = leaf, best
            else:
                made.append(words)
                template[line] = leaf, len(made) - 1
    documents = defaultdict(set)
    for id_, _, line in lines:
        documents[template[line]].add(id_)
    return {(id_, no, len(documents[template[line]])) for id_, no, line in lines if len(documents[template[line]]) >= least}


def water(budget: float, weights: dict, caps: dict) -> dict:
    """Shares by weight, none above its cap, what is left over to the others."""
    out, open_ = {}, dict(weights)
    while open_:
        full = [k for k in open_ if caps[k] <= budget * open_[k] / sum(open_.values())]
        if not full:
            total = sum(open_.values())
            return out | {k: budget * w / total for k, w in open_.items()}
        for k in full:
            out[k] = caps[k]
            budget -= caps[k]
            del open_[k]
    return out


def mixture(docs: list[tuple], fraction: float, epochs: int, seed: str, targets=None) -> Counter:
    """How often each (id, epoch) is chosen; docs: (id, text, lang, source)."""
    from tramline.llm import mixing as m

    targets = targets or m.DEFAULT
    domain_of = {s: d for d, ss in targets.domains.items() for s in ss}
    leaves = defaultdict(list)
    for id_, text, lang, source in docs:
        if tokens(text):
            source = source if source is not None else "unknown"
            leaves[domain_of.get(source, m.OTHER_DOMAIN), lang if lang is not None else "unknown", source].append((id_, len(tokens(text))))
    size = {k: sum(n for _, n in v) for k, v in leaves.items()}
    cap = {k: n * epochs for k, n in size.items()}
    part = lambda n, p: [k for k in cap if k[:n] == p]
    budget = sum(size.values()) * fraction
    quota: dict = {}
    domains = {k[0] for k in cap}
    for d, b in water(budget, {d: targets.domain_weights.get(d, targets.domain_other) for d in domains}, {d: sum(cap[k] for k in part(1, (d,))) for d in domains}).items():
        langs = {k[1] for k in part(1, (d,))}
        for la, c in water(b, {x: targets.lang_weights.get(x, targets.lang_other) for x in langs}, {x: sum(cap[k] for k in part(2, (d, x))) for x in langs}).items():
            own = part(2, (d, la))
            quota |= water(c, {k: targets.source_weights.get(k[2], targets.source_other) for k in own}, {k: cap[k] for k in own})
    out: Counter = Counter()
    for k, rows in leaves.items():
        whole, rest = divmod(math.floor(quota[k] + 1e-6), size[k])
        for e in range(whole):
            out.update((id_, e) for id_, _ in rows)
        key = lambda id_: hashlib.md5(f"{seed}:{whole}:{'null' if id_ is None else id_}".encode()).hexdigest()  # noqa: E731, B023
        by = defaultdict(list)
        for id_, n in rows:
            by[key(id_)].append((id_, n))
        used = 0
        for h in sorted(by):
            used += sum(n for _, n in by[h])
            if used > rest:
                break
            out.update((id_, whole) for id_, _ in by[h])
    return out


def passage(seed: int, n: int) -> str:
    return " ".join(hashlib.md5(f"{seed}/{i}".encode()).hexdigest()[: 3 + i % 6] for i in range(n))


def awkward() -> list[tuple]:
    """Nulls in every column, empty, blank, one-word, repeated and very long texts, and repeated rows."""
    long = passage(1, 30_000)
    shared = passage(2, 60)
    return [
        (1, shared, "en", "src0", 1), (1, shared, "en", "src0", 1), (2, shared, "de", None, None), (3, None, "en", "src1", 0), (4, "", "en", "src1", 0),
        (5, "  \n\t ", None, "src2", 4), (6, "one", "fr", "src3", 3), (7, "one", "fr", "src3", 3), (None, "no id at all but words enough", "en", "src4", 9),
        (None, None, None, None, None), (8, long, "en", "src0", len(long)), (9, long + " end", "en", "src0", len(long)), (10, passage(3, 40) + " " + shared + " " + passage(4, 40), "es", "src9", 5),
        (11, "Zażółć gęślą jaźń 漢字 😀 " * 3, "pl", "src12", 7), (14, "short words " * 5000 + "a" * 400 + " three four five six", "en", "src6", 1),
        (15, "敏捷的棕色狐狸跳过了懒惰的狗，然后跑进了森林里面去寻找食物。" * 2, "zh", "src6", 1), (16, "敏捷的棕色狐狸跳过了懒惰的狗，然后跑进了森林里面去寻找食物！" * 2, "zh", "src6", 1), (12, passage(5, 200), "en", "src5", 1), (13, passage(5, 190) + " " + passage(6, 10), "en", "src6", 1),
    ]
