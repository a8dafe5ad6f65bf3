"""Plain versions of the operators, for small inputs."""

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def five_grams(text):
    words = WORD.findall(text or "")
    return frozenset(tuple(words[j : j + 5]) for j in range(max(1, len(words) - 4))) if words else frozenset()


def jaccard_classes(texts: dict):
    """Links and smallest component member of each id."""
    sets = {i: five_grams(t) for i, t in texts.items()}
    links, root = Counter(), {i: i for i in texts}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            common = len(sets[a] & sets[b])
            if common and common >= 0.8 * (len(sets[a]) + len(sets[b]) - common):
                links[a] += 1
                links[b] += 1
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {i: (links[i], top(i)) for i in ids}


def cut_repeats(raws: list[bytes], length=200):
    """For each text the remaining bytes, the removed bytes and the number of runs."""
    seen = Counter(r[p : p + length] for r in raws for p in range(len(r) - length + 1))
    out = []
    for r in raws:
        mask = bytearray(len(r))
        for p in range(len(r) - length + 1):
            if seen[r[p : p + length]] > 1:
                mask[p : p + length] = b"\1" * length
        runs = sum(1 for k in range(len(mask)) if mask[k] and (not k or not mask[k - 1]))
        out.append((bytes(x for x, m in zip(r, mask, strict=True) if not m), sum(mask), runs))
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            fits = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if fits:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def bootstrap(texts):
    """Spans that contexts add, by text: a plain version of the rounds over patterns and instances."""
    kinds = ("email", "ip", "card", "phone")
    edges = set("\".,;:!?'()[]<>{}")
    bare = lambda w: w.strip("".join(edges)).lower()
    spaced = lambda t: re.sub(r"[\n\t\r]", " ", t)
    number = r"\+?\(?[0-9](?:[ ().-]{0,2}[0-9])*"
    at, dot = r"(?: ?[(\[]at[)\]] ?| at )", r"(?:\.| ?[(\[]dot[)\]] ?| dot )"
    address = rf"[\w.%+-]+(?:@[A-Za-z0-9-]+(?:{dot}[A-Za-z0-9-]+)*|{at}[A-Za-z0-9-]+(?:{dot}[A-Za-z0-9-]+)+)"
    colons = r"[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){3,7}"
    run = re.compile(rf"(?<![\w.%+-]){address}|(?<![A-Za-z0-9])(?:{colons}(?![A-Za-z0-9:])|{number}(?![A-Za-z0-9]))", re.ASCII)
    shapes = {"email": address, "ip": colons, "card": r"[0-9]{4}(?:[ -]?[0-9]){9,11}", "phone": r"\(?[0-9]{2,4}\)?[0-9(). -]{5,14}"}
    mentions = []
    for d, text in enumerate(texts):
        stretches = [(int(a), int(b)) for a, b in (s.split(":")[1:] for s in base_spans(text))]
        last, found = 0, list(run.finditer(text))
        for i, m in enumerate(found):
            after = text[m.end() : found[i + 1].start()] if i + 1 < len(found) else text[m.end() :]
            near = (spaced(text[last : m.start()][-60:]).rstrip(" ").rpartition(" ")[2], spaced(after[:60]).lstrip(" ").partition(" ")[0])
            last = m.end()
            whole = [s.split(":")[0] for s in base_spans(m[0]) if s.split(":", 1)[1] == f"0:{len(m[0])}"]
            own = whole[:1] or [
                k for k in kinds if re.fullmatch(shapes[k], m[0], re.ASCII) and (k != "phone" or 7 <= sum(c.isdigit() for c in m[0]) <= 12)
            ]
            free = all(b <= m.start() or a >= m.end() for a, b in stretches)
            slots = [(side, bare(w)) for side, w in zip(("before", "after"), near, strict=True) if bare(w)]
            mentions.append((d, m[0], m[0].lower(), own, bool(whole), slots, free))
    places, count, seeds = Counter(), Counter(), set()
    for _, _, token, own, seed, slots, _ in mentions:
        places.update(slots)
        for k in own:
            count.update((k, s, token) for s in slots)
            if seed and slots:
                seeds.add((k, token))
    score = dict.fromkeys(seeds, 1.0)
    while True:
        weight, support = Counter(), Counter()
        for (k, s, t), n in count.items():
            if (k, t) in score:
                weight[k, s] += n * score[k, t]
                support[k, s] += 1
        good = {p: weight[p] / places[p[1]] for p in weight if weight[p] / places[p[1]] >= 0.5 and support[p] >= 5}
        miss = {}
        for k, s, t in count:
            if (k, s) in good and (k, t) not in seeds:
                miss[k, t] = miss.get((k, t), 1.0) * max(1 - good[k, s], 1e-9)
        new = dict.fromkeys(seeds, 1.0) | {i: 1 - x for i, x in miss.items() if 1 - x >= 0.8}
        if new == score:
            break
        score = new
    added = {}
    for d, written, token, _, _, slots, free in mentions:
        hit = {k for k in kinds if (k, token) in score and (k, token) not in seeds and any((k, s) in good for s in slots)}
        if free and hit:
            added.setdefault(d, []).extend((k, written) for k in hit)
    return {d: sorted(x) for d, x in added.items()}
