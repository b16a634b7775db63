"""Plain-Python restatements of the operators, for small inputs."""
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

LOW = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fold(text):
    return (text or "").encode().translate(LOW).decode()


# ------------------------------------------------------------------ language model
def tokens(text):
    return [w.encode() for w in re.split(r"[\x20\x09-\x0d]+", fold(text)) if w]


def context_tree(docs, held, depth):
    """(id, held, n_tokens, n_known, train_tokens, base, score) per document."""
    toks = [tokens(t) for _, t in docs]
    count, ends = Counter(), 0
    for h, t in zip(held, toks):
        if not h:
            count.update(t)
            ends += 1
    total, kinds = sum(count.values()) + ends, len(count) + (1 if ends else 0)
    log_all = math.log10(total + .5 * (kinds + 1))

    def steps(t):
        text = b"".join(w + b" " for w in t) + b"\n"
        s = (257,) + tuple(b + 1 for b in text)
        for j, b in enumerate(text):
            yield s[max(0, j + 1 - depth):j + 1], b
    nodes = defaultdict(lambda: [0, 0])
    for h, t in zip(held, toks):
        for ctx, b in steps(t) if not h else ():
            for d in range(len(ctx) + 1):
                for k in range(8):
                    nodes[ctx[len(ctx) - d:], (256 | b) >> (8 - k)][(b >> (7 - k)) & 1] += 1
    kids, weight, keep = defaultdict(list), {}, {}
    for c, u in nodes:
        if c:
            kids[c[1:], u].append((c, u))
    for c, u in sorted(nodes, key=lambda x: -len(x[0])):
        a, b = nodes[c, u]
        own = math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)
        if not kids.get((c, u)):
            weight[c, u], keep[c, u] = own, 1
        else:
            s = sum(weight[k] for k in kids[c, u])
            m = max(own, s)
            weight[c, u] = m + math.log(math.exp(own - m) + math.exp(s - m)) - math.log(2)
            keep[c, u] = 1 / (1 + math.exp(max(-700, min(700, s - own))))

    def one(ctx, u, d=0):
        c = ctx[len(ctx) - d:]
        if (c, u) not in nodes:
            return .5
        a, b = nodes[c, u]
        own, share = (b + .5) / (a + b + 1), keep[c, u]
        return own if share == 1 and d == len(ctx) else share * own + (1 - share) * one(ctx, u, d + 1)

    def cost(ctx, b):
        ps = [one(ctx, (256 | b) >> (8 - k)) for k in range(8)]
        return sum(math.log(p if (b >> (7 - k)) & 1 else 1 - p) for k, p in enumerate(ps))
    out = []
    for (i, _), h, t in zip(docs, held, toks):
        base = sum(math.log10(count[w] + .5) - log_all for w in t) + math.log10(ends + .5) - log_all
        score = sum(cost(c, b) for c, b in steps(t))
        out.append((i, h, len(t) + 1, sum(count[w] > 0 for w in t) + (ends > 0), total, base, score / math.log(10)))
    return out


# ------------------------------------------------------------------ personal data
PII = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
       ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def pii_spans(text):
    def valid(kind, m):
        d = re.sub("[^0-9]", "", m)
        if kind == "ip":
            return all(int(p) <= 255 for p in m.split("."))
        if kind == "card":
            return 13 <= len(d) <= 19 and luhn(d)
        return kind == "email" or 9 <= len(d) <= 15
    return [(k, m.start(), m.end()) for k, p in PII for m in re.finditer(p, text or "") if valid(k, m.group())]


# ------------------------------------------------------------------ decontamination
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contaminated(docs, items, width=10):
    """(id, n_words, n_hit, n_items, sha of items) per document."""
    win = defaultdict(set)
    for i, t in items:
        w = WORD.findall(fold(t))
        if w and i is not None:
            for s in range(max(1, len(w) - width + 1)):
                win[tuple(w[s:s + width])].add(str(i))
    out = []
    for d, t in docs:
        w, hit, its = WORD.findall(fold(t)), set(), set()
        for n in {len(k) for k in win}:
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in win:
                    hit.update(range(s, s + n))
                    its |= win[tuple(w[s:s + n])]
        out.append((d, len(w), len(hit), len(its), hashlib.sha256(",".join(sorted(its)).encode()).hexdigest()))
    return out


# ------------------------------------------------------------------ near-duplicates
def near_classes(docs, similar=0.8):
    bags = []
    for _, t in docs:
        w = WORD.findall(fold(t))
        k = min(5, len(w))
        bags.append(Counter(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if w else Counter())
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(docs)):
        for b in range(a):
            same = sum((bags[a] & bags[b]).values())
            if same and same / (sum(bags[a].values()) + sum(bags[b].values()) - same) >= similar:
                parent[find(a)] = find(b)
    group = defaultdict(list)
    for n, (i, _) in enumerate(docs):
        group[find(n)].append(i)
    smallest = {k: min((i for i in v if i is not None), default=None) for k, v in group.items()}
    return [(i, smallest[find(n)]) for n, (i, _) in enumerate(docs)]


# ------------------------------------------------------------------ search
def top_k(vectors, k=20):
    usable = [(i, [math.floor(64 * x) for x in v]) for i, v in vectors
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, v) in enumerate(usable):
        if i % 20 == 0:
            best = sorted((-sum(x * y for x, y in zip(v, w)), j) for b, (j, w) in enumerate(usable) if a != b)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return out


# ------------------------------------------------------------------ urls
def judge(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = rest[:min([rest.index(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(len(h + p), len(h), v, h + p) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, default, None))
    return host, path, best[3], best[2]


def crc_mod(i, m):
    return zlib.crc32(str(i).encode()) % m


# ------------------------------------------------------------------ nearest vectors
def nearest(vectors, k=10, every=100):
    """Per query row its k nearest (distance, id), other rows only."""
    usable = [(i, v) for i, v in vectors if i is not None and v is not None and any(v)
              and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, v) in enumerate(usable):
        if i % every == 0:
            best = sorted((math.sqrt(sum((x - y) ** 2 for x, y in zip(v + [0.0] * (len(w) - len(v)), w + [0.0] * (len(v) - len(w))))), j)
                          for b, (j, w) in enumerate(usable) if a != b)[:k]
            out += [(i, r + 1, j, d) for r, (d, j) in enumerate(best)]
    return out


# ------------------------------------------------------------------ spelling
def spelling_words(docs, least=5, times=3):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= least and c >= times}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def spelling(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return out


# ------------------------------------------------------------------ resampling
def resample(docs, target, percent=5, least=20, buckets=10000):
    def feats(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in (1, 2, 3) for i in range(len(w) - n + 1)]
    own, s, t = [feats(x) for _, x in docs], Counter(), Counter()
    for _, f in own:
        s.update(f)
    for x in target:
        t.update(feats(x)[1])
    S, T = float(sum(s.values())), float(sum(t.values()))
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (S + buckets) / ((s[b] + 1.0) * (T + buckets)))) for b in range(buckets)]
    rows = []
    for (i, _), (n, f) in zip(docs, own):
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in f)
        rows.append([i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in rows]
