"""Plain versions of what the operators compute, and texts that are hard for them."""

from __future__ import annotations

import collections
import hashlib
import itertools
import re
import zlib

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

PASSAGE = " ".join(f"word{i}" for i in range(40))
ODD_TEXTS = [
    None,
    "",
    "  \n\t ",
    "one two three four",
    "One TWO three four",
    "!!! 123 ---",
    "Straße İstanbul ΣΑΣ naïve 中文字符 😀 a‍b   x\x1cy <|endoftext|> it's we'll 42",
    "a  b\n\n c \r\n d\x0be",
    "long " + " ".join(f"w{i % 977}x{i // 977}" for i in range(60_000)),
    "y" * 300_000,
    f"start {PASSAGE} end",
    f"other {PASSAGE} close {PASSAGE}",
    "loop " * 80,
    "mail a.b@c-d.example.org, x@y.z+q@r.s and 10.0.0.255 or 999.1.1.1 or 1.2.3.4.5 call +1 (202) 555-0143 or +12 34",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112 and 000000000000000000 1 2 3",
    "😀 é  4242424242424242+49 30 1234567",
]


def family(rng) -> list[str]:
    """Near copies of one text: word edits from none to many."""
    base = [f"term{rng.randrange(10**6)}" for _ in range(120)]
    out = []
    for edits in (0, 0, 1, 1, 1, 2, 2, 3, 4, 8, 30):
        words = list(base)
        for place in rng.sample(range(120), edits):
            words[place] = f"edit{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def words(text) -> list[str]:
    return WORD.findall(text or "")


def shingles(text) -> frozenset:
    own = words((text or "").translate(LOWER))
    if len(own) < 5:
        return frozenset([tuple(own)] if own else [])
    return frozenset(zip(*[own[i:] for i in range(5)], strict=False))


def components(docs: dict, linked: int = 85) -> dict:
    """Smallest reachable id by id, all pairs of different sets compared."""
    sets = collections.defaultdict(list)
    for number, text in docs.items():
        sets[shingles(text)].append(number)
    parent = {n: n for n in docs}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    def join(a, b):
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)

    own = [(s, n) for s, n in sets.items() if s]
    for s, numbers in own:
        for n in numbers:
            join(numbers[0], n)
    for i, (s, a) in enumerate(own):
        for t, b in own[:i]:
            both = len(s & t)
            if 100 * both >= linked * (len(s) + len(t) - both):
                join(a[0], b[0])
    return {n: root(n) for n in docs}


def repeats(rows: list[tuple], window: int = 35) -> list[tuple]:
    """(doc_id, n_words, n_removed, kept_sha256) of each row."""
    counts = collections.Counter()
    for _, text in rows:
        own = words(text)
        counts.update(tuple(own[i : i + window]) for i in range(len(own) - window + 1))
    out = []
    for number, text in rows:
        own = words(text)
        covered = [False] * len(own)
        for i in range(len(own) - window + 1):
            if counts[tuple(own[i : i + window])] > 1:
                covered[i : i + window] = [True] * window
        kept = " ".join(w for w, c in zip(own, covered, strict=True) if not c)
        out.append((number, len(own), sum(covered), hashlib.sha256(kept.encode()).hexdigest()))
    return out


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits: str) -> bool:
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def base_spans(text) -> list[str]:
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 13 <= len(digits) <= 19 and _luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]()
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def odd_turns(rng) -> list[tuple]:
    """Rows of conversations with any roles, faults, repeated and missing turns, nulls and a null id."""
    out = []
    for number in range(5000, 5120):
        for turn in range(rng.choice([1, 3, 8, 40, 150])):
            place = rng.choice([turn, turn, None if rng.random() < 0.1 else turn, turn // 2])
            role = rng.choice(["user", "assistant", "system", "tool", "", None]) if number % 2 else ("user", "assistant")[turn % 2]
            text = rng.choice(["a.", "b", "c!", "", " ", None, "same.", f"x{turn}.\t", f"y{turn}", "\u3000"])
            out.append((number if number % 40 else None, place, role, text))
    # A long run of one copy, and one of turns that fit nowhere.
    out += [(6000, 7, "user", "again.")] * 400 + [(6001, n, "system", f"rule {n}.") for n in range(300)]
    return out


def damaged(rows: list[tuple]) -> dict:
    """Rows after damage, in order, by conversation."""
    out = collections.defaultdict(list)
    for number, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (number, turn)).encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        if kind == 4:
            role = "user"
        out[number] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    for own in out.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return out


FOLLOWS = {"": "u", "s": "u", "u": "a", "a": "u"}
ROLES = {"u": "user", "a": "assistant"}


def _inserted(paths: dict) -> dict:
    while True:
        new = dict(paths)
        for state, (cost, audit, turns) in paths.items():
            to = FOLLOWS[state]
            new[to] = min(new.get(to, (10**9,)), (cost + 3, audit + "I", (*turns, ROLES[to] + ":")))
        if new == paths:
            return paths
        paths = new


def repairs(rows: list[tuple]) -> dict:
    """By conversation: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256; whole paths are kept."""
    out = {}
    for number, own in damaged(rows).items():
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, counts = set(), collections.Counter()
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        paths = _inserted({"": (0, "", ())})
        for _, role, text in own:
            end = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "" if end[-1] in ".!?" else "truncated"
            seen.add((role, text))
            counts[fault] += 1
            new: dict = {}
            for state, (cost, audit, done) in paths.items():
                found = [(state, (cost + 4, audit + "D", done))]
                if fault in ("", "truncated"):
                    price, to = cost + 3 * (fault == "truncated"), FOLLOWS[state]
                    found.append((to, (price + 3, audit + "R", (*done, f"{ROLES[to]}:{text}"))))
                    if role and state + role[0] in ("s", "u", "su", "ua", "au"):
                        found.append((role[0], (price, audit + "K", (*done, f"{role}:{text}"))))
                for to, path in found:
                    new[to] = min(new.get(to, (10**9,)), path)
            paths = _inserted(new)
        cost, audit, done = min(paths[s] for s in ("", "a") if s in paths)
        digest = hashlib.sha256("\n".join(done).encode()).hexdigest()
        out[number] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest)
    return out


def spellings(rows: list[tuple]) -> dict:
    """By word: form, root, n, n_near, form_n; near words share what is left without a letter."""
    counts = collections.Counter()
    for number, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            word = run.translate(LOWER)
            h = zlib.crc32(f"{'' if number is None else number}:{word}".encode())
            place = h % len(word)
            counts[word[:place] + word[place + 1 :] if h % 199 == 0 else word] += 1
    n = {w: c for w, c in counts.items() if c >= 5 and len(w) >= 6}
    near, without = collections.defaultdict(set), collections.defaultdict(set)
    for word in n:
        for i in range(len(word)):
            less = word[:i] + word[i + 1 :]
            without[i, less].add(word)
            if less in n:
                near[word].add(less)
                near[less].add(word)
    for group in without.values():
        for word in group:
            near[word] |= group - {word}
    best = {w: min(own, key=lambda x: (-n[x], x)) for w, own in near.items() if own}
    form = {w: f for w, f in best.items() if n[f] >= 5 * n[w]}
    out = {}
    for word in n:
        root = word
        while root in form:
            root = form[root]
        out[word] = (form.get(word), root, n[word], len(near[word]), n.get(form.get(word)))
    return out
