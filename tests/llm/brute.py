"""Plain versions of the operators, for small tables."""

import hashlib
import heapq
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

FORMS = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text)


def base_spans(text):
    found = []
    for order, (kind, pattern, group, least) in enumerate(FORMS):
        found += [(m.start(), order, kind, m.end()) for m in pattern.finditer(text or "") if len(m.group(group)) >= least]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def shingle_set(text):
    words = WORD.findall(ascii_lower(text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


class Ties:
    def __init__(self):
        self.parent = {}

    def root(self, x):
        while self.parent.setdefault(x, x) != x:
            x = self.parent[x]
        return x

    def tie(self, x, y):
        x, y = self.root(x), self.root(y)
        self.parent[max(x, y)] = min(x, y)


def near_duplicates(rows, percent=85):
    """{doc_id: (n_shingles, component)} by comparing all pairs that share a shingle."""
    sets = {i: shingle_set(t) for i, t in rows}
    ties, holders = Ties(), defaultdict(list)
    for i, items in sets.items():
        shared = Counter(j for x in items for j in holders[x])
        for j, both in shared.items():
            if 100 * both >= percent * (len(items) + len(sets[j]) - both):
                ties.tie(i, j)
        for x in items:
            holders[x].append(i)
    return {i: (len(items), ties.root(i)) for i, items in sets.items()}


def linked_vectors(rows, threshold=0.93):
    """{vec_id: (n_links, component)} of (vec_id, label, vector), all pairs."""
    ties, links = Ties(), Counter()
    good = [
        (i, label, np.array(v, dtype=float))
        for i, label, v in rows
        if label is not None and v is not None and None not in v and np.isfinite(np.array(v, dtype=float)).all() and any(v)
    ]
    for k, (i, label, v) in enumerate(good):
        for j, other, w in good[:k]:
            if label == other and len(v) == len(w) and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= threshold:
                ties.tie(i, j)
                links.update((i, j))
    return {i: (links[i], ties.root(i)) for i, *_ in rows}


def top_k(rows, stride, k):
    out = []
    whole = [(i, np.floor(256 * np.array(v, dtype=float)).astype(int)) for i, v in rows if v is not None and None not in v and np.isfinite(np.array(v, dtype=float)).all()]
    for q, w in whole:
        if q % stride == 0:
            best = sorted((-int(w[: len(v)] @ v[: len(w)]), i) for i, v in whole if i != q)[:k]
            out += [(q, rank, i, -score) for rank, (score, i) in enumerate(best, 1)]
    return sorted(out)


def clean_lines(rows, min_docs=3, min_points=20):
    """{doc_id: (n_lines, n_dropped, kept)}"""

    def key(line):
        return ascii_lower(line.strip(" \t\n\x0b\x0c\r"))

    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_points:
                holders[key(line)].add(i)
    out = {}
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(holders.get(key(x), ())) >= min_docs and max(holders[key(x)]) != i)]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def targets(sizes, weights, share, most):
    """Targets by resharing the excess until none is above; sizes in the order of the sources."""
    total, got = share * sum(sizes), [0.0] * len(sizes)
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    open_, left = set(range(len(sizes))), total
    while open_:
        whole = sum(weight[i] for i in open_)
        over = {i for i in open_ if left * weight[i] / whole > most * sizes[i]}
        if not over:
            for i in open_:
                got[i] = left * weight[i] / whole
            break
        for i in over:
            got[i] = float(most * sizes[i])
            left -= got[i]
        open_ -= over
    return got


def sha256(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def parsed_windows(rows, window=20):
    """{doc_id: (n_words, kept words)}; a window goes if it also starts earlier; doc_ids are unique."""
    words = {i: WORD.findall(t or "") for i, t in rows}
    first, gone = {}, defaultdict(set)
    for i in sorted(words, key=lambda i: (i is not None, i)):
        for s in range(len(words[i]) - window + 1):
            if first.setdefault(tuple(words[i][s : s + window]), (i, s)) != (i, s):
                gone[i].update(range(s, s + window))
    return {i: (len(w), [x for k, x in enumerate(w) if k not in gone[i]]) for i, w in words.items()}


def slipped_words(rows, slip):
    out = []
    for i, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = ascii_lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if slip and h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out.append(run)
    return out


def variants(words, least_points=5, least_count=3, factor=2):
    """{word: (form, root, n, n_near, form_n)} from all words one edit away, made by deleting letters."""
    n = {w: k for w, k in Counter(words).items() if len(w) >= least_points and k >= least_count}
    holes = defaultdict(set)
    for w in n:
        for k in range(len(w)):
            holes[w[:k] + "\0" + w[k + 1 :]].add(w)  # replaced
    near = defaultdict(set)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    for w in n:
        for k in range(len(w)):
            if (less := w[:k] + w[k + 1 :]) in n:
                near[w].add(less)
                near[less].add(w)
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= factor * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def damage(rows):
    """Rows (conv_id, turn, role, text) with what the contract of op13 does to them."""
    out = []
    for row in rows:
        conv, turn, role, text = row
        conv_key, turn_key, role, text = (" " if x is None else x for x in row)
        harm = zlib.crc32(f"{conv_key}:{turn_key}".encode()) % 20
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        out += [(conv, turn, "user" if harm == 4 else role, text)] * {0: 0, 3: 2}.get(harm, 1)
    return out


def repair(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, text) of one conversation's rows, by trying all paths in order of cost."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).digest()))
    turns = [r[1] for r in rows if r[1] is not None]
    faults, seen = [], set()
    for _, _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [r[2][:1] for r in rows]
    legal = re.compile(r"(s?(ua)+)?")
    start = re.compile(r"s?(ua)*u?")
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, roles, lines = heapq.heappop(heap)
        if i == len(rows) and legal.fullmatch(roles):
            break
        if (i, key := (roles[-1:])) in done:
            continue
        done.add((i, key))

        def push(edit, price, step, role, text):
            grown = roles + role[:1]
            if start.fullmatch(grown):
                heapq.heappush(heap, (cost + price, audit + edit, i + step, grown, lines + (f"{role}:{text}",)))

        for role in ("user", "assistant"):
            push("I", 3, 0, role, "")
        if i < len(rows):
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, roles, lines))
            if faults[i] not in ("blank", "duplicate"):
                more = 3 * (faults[i] == "truncated")
                if initials[i] in ("s", "u", "a"):
                    push("K", more, 1, rows[i][2], rows[i][3])
                for role in ("user", "assistant"):
                    push("R", 3 + more, 1, role, rows[i][3])
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost,
        audit,
        "\n".join(lines),
    )


def best_fit(sizes, capacities, overhead, quadratic):
    """Bin and offset of each size, and the bins' capacities, by looking at every bin for every size.

    Of bins with equal room the one touched last is taken.
    """
    price = {c: overhead + c + c * c / quadratic for c in capacities}
    left, bins, places = sum(sizes), [], {}
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        fitting = [b for b in bins if b["opened"] - b["filled"] >= sizes[k]]
        if fitting:
            b = min(fitting, key=lambda b: (b["opened"] - b["filled"], -b["touched"]))
        else:
            able = [c for c in sorted(capacities) if c >= sizes[k]]
            b = {"name": len(bins), "opened": min(able, key=lambda c: price[c] / min(c, left)), "filled": 0}
            bins.append(b)
        places[k] = b["name"], b["filled"]
        b["filled"], b["touched"] = b["filled"] + sizes[k], len(places)
        left -= sizes[k]
    made = [min(c for c in capacities if c >= b["filled"]) for b in bins]
    return [places[k][0] for k in range(len(sizes))], [places[k][1] for k in range(len(sizes))], made
