"""Plain versions of the operators, for small tables only."""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
from collections import Counter, defaultdict

import public_tokenizers

SPACE_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text: str | None) -> list[bytes]:
    return SPACE_WORD.findall((text or "").encode())


def hf_tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def tiktoken_encoding():
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def best_fit_decreasing(lengths: list[int], capacity: int) -> int:
    """Sequences that sequential best fit, longest first, needs."""
    gaps, used = [], 0
    for x in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, x)
        if at == len(gaps):
            used += 1
            left = capacity - x
        else:
            left = gaps.pop(at) - x
        bisect.insort(gaps, left)
    return used


def substring_dedup(rows: list[tuple[int | None, str | None]], window: int = 50) -> list[tuple]:
    docs = [(i, words(t)) for i, t in rows]
    first: dict[tuple, int] = {}
    for i, w in docs:
        if i is not None:
            for s in range(len(w) - window + 1):
                key = tuple(w[s : s + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in docs:
        gone = [False] * len(w)
        if i is not None:
            for s in range(len(w) - window + 1):
                if first[tuple(w[s : s + window])] < i:
                    gone[s : s + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def jaccard_groups(rows: list[tuple[int, str | None]], n: int = 5, percent: int = 75) -> list[tuple]:
    sets = []
    for _, t in rows:
        w = words(lower(t or ""))
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    inside = defaultdict(list)
    for k, s in enumerate(sets):
        for gram in s:
            inside[gram].append(k)
    common = Counter((a, b) for ks in inside.values() for x, a in enumerate(ks) for b in ks[x + 1 :])
    parent = list(range(len(sets)))

    def root(k: int) -> int:
        while parent[k] != k:
            k = parent[k]
        return k

    for (a, b), c in common.items():
        if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            parent[root(a)] = root(b)
    least: dict[int, int] = {}
    for k, (i, _) in enumerate(rows):
        least[root(k)] = min(least.get(root(k), i), i)
    return [(i, len(s), least[root(k)]) for k, ((i, _), s) in enumerate(zip(rows, sets))]


def quality_counts(text: str | None) -> tuple:
    t = text or ""
    w = words(t)
    windows = defaultdict(list)
    for k in range(len(w) - 2):
        windows[tuple(w[k : k + 3])].append(k)
    again = {p for places in windows.values() if len(places) > 1 for k in places for p in (k, k + 1, k + 2)}
    lines = [line for line in t.split("\n") if words(line)]
    failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
    return len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again), failed


def base_licenses(text: str | None) -> tuple:
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    phrases = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
    found = sorted((k, label) for phrase, label in phrases.items() for k in range(len(w)) if w[k : k + len(phrase.split())] == phrase.split())
    labels = ",".join(sorted({label for _, label in found}))
    return len(w), len(found), found[0][0] if found else None, found[-1][0] if found else None, labels


def tool_rows(messages: list[tuple], tools: set[str]) -> list[tuple]:
    """(conv, turn, call id, status, json) of every call and every result without one."""
    dump = lambda x: json.dumps(x, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    asked, calls, out = {}, [], []
    turns = sorted(messages, key=lambda m: (m[0], m[1]))
    for conv, turn, role, text in turns:
        if role != "assistant":
            continue
        batch = json.loads(text)["tool_calls"]
        known = {}
        for c in batch:
            known.setdefault(c["id"], c)
        # a call is stuck if what it waits for, followed on, comes back or waits for what does
        def stuck(c, path=()):
            return any(a in path or (a in known and stuck(known[a], (*path, a))) for a in c.get("after", []))

        fine = [c for c in batch if not stuck(c, (c["id"],))]
        # topological place: only needed to say which of two equal ids is the first
        done, order, rest = set(), [], list(enumerate(batch))
        while rest:
            ready = [(k, c) for k, c in rest if all(a not in known or a in done or a not in {d["id"] for _, d in rest} for a in c.get("after", []))]
            k, c = ready[0] if ready else rest[0]
            order.append(k)
            rest = [(j, d) for j, d in rest if j != k]
            if known[c["id"]] is c:
                done.add(c["id"])
        for place, k in enumerate(order):
            calls.append((conv, turn, place, batch[k], batch[k] not in fine))
    for conv, turn, place, c, loop in calls:
        asked.setdefault((conv, c["id"]), (turn, place))
    results = {}
    for conv, turn, role, text in turns:
        if role == "tool":
            found = json.loads(text)
            key = (conv, found["tool_call_id"])
            if key in asked and asked[key][0] < turn:
                results.setdefault(key, found["content"])
            else:
                out.append((conv, turn, found["tool_call_id"], "orphan", found["content"]))
    for conv, turn, place, c, loop in calls:
        key, first = (conv, c["id"]), asked[conv, c["id"]] == (turn, place)
        result = results.get(key) if first else None
        if not c.get("name"):
            status = "malformed"
        elif not first:
            status = "duplicate id"
        elif loop:
            status = "cycle"
        elif c["name"] not in tools:
            status = "unknown tool"
        elif c["name"] == "count_words" and not c["arguments"]["text"]:
            status = "invalid: text too short"
        elif any(asked.get((conv, a), (turn + 1,))[0] > turn for a in c.get("after", [])):
            status = "unknown dependency"
        else:
            status = "ok" if result is not None else "no result"
        body = {"arguments": c["arguments"], "id": c["id"]} | ({"name": c["name"]} if c.get("name") else {}) | ({} if result is None else {"result": result})
        out.append((conv, turn, c["id"], status, dump(body)))
    return out


def alignment_rows(rows: list[tuple]) -> list[tuple]:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) by both libraries, document by document."""
    import sentencepiece
    from tokenizers.pre_tokenizers import ByteLevel

    a = hf_tokenizer()
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = sorted(ByteLevel.alphabet())
    byte = {c: ord(c) for c in letters if ord(c) < 256}
    rest = [v for v in range(256) if v not in byte.values()]
    byte |= dict(zip(sorted(c for c in letters if ord(c) >= 256), rest))
    docs = []
    for doc, text in rows:
        groups = []
        if text:
            left = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
            right = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
            whole = (" " + text).encode()
            if b"".join(x for _, x in left) == whole == b"".join(x for _, x in right):
                ends, sides = [], []
                for side in (left, right):
                    at, places = 0, []
                    for _, x in side:
                        at += len(x)
                        places.append(at)
                    ends.append(places)
                    sides.append([i for i, _ in side])
                common = sorted(set(ends[0]) & set(ends[1]))
                groups = [([], []) for _ in common]
                for k in (0, 1):
                    for i, e in zip(sides[k], ends[k]):
                        groups[bisect.bisect_left(common, e)][k].append(i)
        docs.append((doc, groups))
    held: Counter = Counter()
    for _, groups in docs:
        held.update({(x, y) for g in groups for x in g[0] for y in g[1]})
    top: dict[int, int] = {}
    for (x, _), n in held.items():
        top[x] = max(top.get(x, 0), n)
    out = []
    for doc, groups in docs:
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        out.append((
            doc, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links), sum(held[p] == top[p[0]] for p in links),
            sum(held[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return out


def article_text(page: str) -> str:
    """Text of a page's <article> by the standard library's parser, a line for each block."""
    from html.parser import HTMLParser

    inline = set("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q s samp small span strong sub sup time u var wbr".split())

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.inside = self.hidden = 0
            self.lines, self.parts = [], []

        def flush(self):
            text = " ".join("".join(self.parts).split())
            self.lines += [text] if text else []
            self.parts = []

        def handle_starttag(self, tag, attrs):
            if tag in ("script", "style", "noscript", "button", "select", "textarea"):
                self.hidden += 1
            elif tag == "br":
                self.parts.append(" ")
            elif tag not in inline:
                self.flush()
                self.inside += tag == "article"

        def handle_endtag(self, tag):
            if tag in ("script", "style", "noscript", "button", "select", "textarea"):
                self.hidden -= 1
            elif tag not in inline:
                self.flush()
                self.inside -= tag == "article"

        def handle_data(self, data):
            if self.inside and not self.hidden:
                self.parts.append(data)

    reader = Reader()
    reader.feed(page)
    reader.close()
    return "\n".join(reader.lines)


def license_findings(text: str | None, templates: dict[str, list[str]]) -> tuple[str, float]:
    """(labels, score): every template as a longest-match regular expression, tried at every word."""
    import regex

    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    line, starts, at = "", [], 0
    for x in w:
        starts.append(at)
        line += x + " "
        at = len(line)
    base = {"cc-by": ["cc by"], "gpl": ["general public license"], "reserved": ["all rights reserved"]}
    labels, covered = set(), set()
    for label, texts in [*base.items(), *templates.items()]:
        for t in texts:
            parts = []
            for optional, wild, word in re.findall(r"\[\[(.*?)\]\]|<<(\d+)>>|(\S+)", t):
                parts.append(rf"(?:{optional} )?" if optional else rf"(?:\S+ ){{0,{wild}}}" if wild else f"{word} ")
            pattern = regex.compile("".join(parts), regex.POSIX)
            for k, start in enumerate(starts):
                if found := pattern.match(line, start):
                    labels.add(label)
                    covered.update(range(k, k + found[0].count(" ")))
    return ",".join(sorted(labels)), len(covered) / len(w) if w else 0.0
