"""Secrets in texts: candidates by pattern, false positives removed by a random forest.

A candidate is a long run of the characters keys are made of that has a digit, or a value
assigned to a name that speaks of secrets, or the password of ``user:password@`` in an
address. What is never a candidate, whatever the forest would say: values of fewer than 8
characters; runs of fewer than 16 without such a name; bare runs without a digit, however
long; what follows a space, a quote, ``<``, ``>``, ``,`` or ``;`` within a value (in
passwords of addresses a slash as well); and values that a name in other words announces.
A bare run loses leading ``=.-_~+/``. The forest looks at its length, how its
characters follow each other, how much of it dictionary words cover, the path of the text
and the words around it. It is trained from labelled findings: pairs of a finding in its
line and path, and whether it was a secret.

Texts are read once, in place; only findings leave the tasks. The forest is a few hundred
kilobytes whatever the corpus.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import map_rows, slices

MIN_RUN, MIN_ASSIGNED = 16, 8
CONTEXT = 80
_RUN = re.compile(r"(?<![A-Za-z0-9+/=_.~-])[A-Za-z0-9+/=_.~-]{%d,}" % MIN_RUN)
_DIGIT = re.compile(r"[0-9]")
_ASSIGNED = re.compile(
    r"(?i)(?:pass|passw(?:or)?d|passphrase|passcode|pwd|secret|token|credentials?|auth(?:orization)?"
    r"|(?:api|access|secret|private|signing|encryption|client|account|license)[_-]?key)[\"']?"
    r"[ \t]{0,3}(?:[:!]?={1,3}>?|:)[ \t]{0,3}[\"']?(?:(?:bearer|basic)[ \t]{1,3})?"
    r"([^\s\"'<>,;]{%d,})" % MIN_ASSIGNED
)
_NAMED = ("pass", "pwd", "secret", "token", "key", "auth", "credential")
_ADDRESS = re.compile(r"://[^\s/:@\"'<>]*:([^\s/\"'<>,;]{%d,})@" % MIN_ASSIGNED)
_TRIM = "=.-_~+/"
SECRET_WORDS = frozenset(
    "token secret password passwd pwd passphrase apikey api key auth bearer credential "
    "credentials private access client signing license webhook".split()
)
HARMLESS_WORDS = frozenset(
    "commit sha sha1 sha256 md5 checksum hash digest uuid guid id version build revision "
    "integrity etag card order invoice phone tel isbn serial example sample dummy mail email "
    "from to call account http https www image data fingerprint".split()
)
TEST_WORDS = frozenset(
    "test tests testing fixture fixtures example examples mock mocks sample docs spec".split()
)
PLACEHOLDERS = frozenset(
    "example your changeme placeholder dummy sample xxxx here todo test redacted insert".split()
)
#: Words that identifiers and addresses are made of.
DICTIONARY = frozenset(
    "about account action address admin app application array async auth back base block body "
    "buffer build byte cache call channel check class client code column common config connect "
    "content context control copy count create current data database date default delete device "
    "document domain email entry error event example export field file filter find format frame "
    "function get global group handle hash header height hello host html http image index info "
    "input insert item java job json key label layout length level library line link list load "
    "log login mail main make manager map max member memory menu message meta method min mode "
    "model name net network node number object offset option order output package param parse "
    "path pattern play point port process profile project property proxy public python query "
    "range read record region report request reset resource response result return route row "
    "rule sample schema screen script search select server service session set size sort source "
    "start state status step string style system table task template test text theme thread "
    "time title tool trace type update upload user util value version view web window word work "
    "world write year".split()
)
_WORD = re.compile(r"[A-Za-z]+|\d+")


@dataclass(frozen=True)
class Finding:
    start: int
    end: int
    value: str
    before: str
    after: str
    path: str


_NAME = re.compile(r"[A-Za-z_.]{2,40}=(?==?[A-Za-z0-9+/_.~-]{8})")
_CLOSING = "!#$%&*.,:)]}-_~/|"


def _run_value(text: str, start: int, end: int) -> tuple[int, int]:
    """A run without the name and the characters around its value."""
    raw = text[start:end].rstrip(_CLOSING)
    lead = len(raw) - len(raw.lstrip(_TRIM))
    # "name=value" without spaces: the finding is the value.
    cut = _NAME.match(raw)
    lead = max(lead, cut.end() if cut else 0)
    return start + lead, start + len(raw)


def _assigned_value(text: str, start: int, end: int) -> tuple[int, int]:
    """An assigned value; within its own quotes nothing is trimmed.

    Elsewhere trailing characters that may be part of a key but more often close a sentence
    go, unless too little would be left.
    """
    quote = text[start - 1]
    if quote in "\"'" and text[end : end + 1] == quote:
        return start, end
    raw = text[start:end].rstrip(_CLOSING)
    lead = len(raw) - len(raw.lstrip("="))
    if 0 < len(raw) - lead < MIN_ASSIGNED:
        return start + lead, end
    return start + lead, start + len(raw)


def findings(text: str, path: str = "") -> list[Finding]:
    """Candidates of a whole text in order, without overlaps.

    An assigned value is a candidate as a whole. A run that meets it gives up what it shares
    and the name; what stands before the name stays a candidate if it is a long run itself.
    """
    low = text.lower()
    values = []
    if any(name in low for name in _NAMED):
        for m in _ASSIGNED.finditer(text):
            start, end = _assigned_value(text, m.start(1), m.end(1))
            if end - start >= MIN_ASSIGNED:
                values.append((start, end, m.start()))
    if "://" in text:
        values += [(m.start(1), m.end(1), m.start(1)) for m in _ADDRESS.finditer(text)]
    assigned: list[tuple[int, int, int]] = []
    for start, end, name in sorted(values):
        if assigned and start < assigned[-1][1]:
            first, last, before = assigned.pop()
            start, end, name = first, max(end, last), min(name, before)
        assigned.append((start, end, name))
    spans, at = [(start, end) for start, end, _ in assigned], 0
    for m in _RUN.finditer(text):
        start, end = m.span()
        # A value holds every run that starts in it; one that starts before ends in it.
        while at < len(assigned) and assigned[at][1] <= start:
            at += 1
        if at < len(assigned) and assigned[at][0] < end:
            end = min(end, assigned[at][2])
            if end - start < MIN_RUN:
                continue
        if _DIGIT.search(text, start, end):
            start, end = _run_value(text, start, end)
            if end - start >= MIN_ASSIGNED:
                spans.append((start, end))
    return [
        Finding(
            start, end, text[start:end],
            text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT], path,
        )
        for start, end in sorted(spans)
    ]


def _class(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3


@lru_cache(maxsize=1)
def _bigrams() -> dict[str, float]:
    """Log-probabilities of letter pairs in dictionary words; a pair never seen has a floor."""
    pairs, firsts = Counter(), Counter()
    for word in DICTIONARY:
        for a, b in zip(word, word[1:], strict=False):
            pairs[a + b] += 1
            firsts[a] += 1
    return {p: math.log((n + 0.1) / (firsts[p[0]] + 2.6)) for p, n in pairs.items()}


def _covered(value: str) -> float:
    """Share of the characters that the longest dictionary words, from the left, cover."""
    low, at, covered = value.lower(), 0, 0
    while at < len(low):
        for n in range(min(12, len(low) - at), 2, -1):
            if low[at : at + n] in DICTIONARY:
                covered += n
                at += n
                break
        else:
            at += 1
    return covered / max(1, len(value))


FEATURES = (
    "length entropy digits upper lower other hex class_changes letter_digit_changes "
    "pair_surprise coverage longest_run distinct dots slashes placeholder prefix assigned quoted "
    "secret_near harmless_near at_sign url_before word_before_is_secret path_test path_depth "
    "groups_like_uuid all_digits letters_outside"
).split()
_PREFIX = re.compile(
    r"^(AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|sk_live_|sk-|rk_live_|xox[abp]-|eyJ|AIza|glpat-|npm_)"
)
_RUNS = re.compile(r"[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+")
_UUID = re.compile(r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$")


def describe(f: Finding) -> list[float]:
    """The features of a finding."""
    v, n = f.value, len(f.value)
    classes = [_class(c) for c in v]
    changes = sum(a != b for a, b in zip(classes, classes[1:], strict=False))
    mixed = sum(
        (a == 0) != (b == 0) for a, b in zip(classes, classes[1:], strict=False)
    )
    counts = Counter(v)
    letters = [c.lower() if c.isalpha() else " " for c in v]
    pairs = [a + b for a, b in zip(letters, letters[1:], strict=False) if " " not in a + b]
    table = _bigrams()
    surprise = -sum(table.get(p, -6.0) for p in pairs) / max(1, len(pairs)) if pairs else 6.0
    low = v.lower()
    before = [w.lower() for w in _WORD.findall(f.before)][-4:]
    after = [w.lower() for w in _WORD.findall(f.after)][:2]
    close = f.before.rstrip(" \t\"'`")
    path = [w.lower() for w in _WORD.findall(f.path)]
    return [
        float(n),
        -sum(k / n * math.log2(k / n) for k in counts.values()),
        classes.count(0) / n,
        classes.count(2) / n,
        classes.count(1) / n,
        classes.count(3) / n,
        float(all(c in "0123456789abcdefABCDEF" for c in v)),
        changes / n,
        mixed / n,
        surprise,
        _covered(v),
        max(len(m) for m in _RUNS.findall(v)) / n,
        len(counts) / n,
        float(v.count(".")),
        float(v.count("/")),
        float(any(w in low for w in PLACEHOLDERS)),
        float(bool(_PREFIX.match(v))),
        float(close.endswith(("=", ":", "=>"))),
        float(f.before.endswith(('"', "'", "`"))),
        float(sum(w in SECRET_WORDS for w in before)),
        float(sum(w in HARMLESS_WORDS for w in [*before, *after])),
        float(f.before.endswith("@") or f.after.startswith("@") or "@" in v),
        float(bool(re.search(r"(?:https?:|www\.|//)\S*$", f.before))),
        float(bool(before) and before[-1] in SECRET_WORDS),
        float(any(w in TEST_WORDS for w in path)),
        float(f.path.count("/")),
        float(bool(_UUID.match(v))),
        float(v.isdigit()),
        sum(c.isalpha() and c.lower() not in "abcdef" for c in v) / n,
    ]


@dataclass
class Tree:
    feature: np.ndarray  # -1 in a leaf
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), dtype="i4")
        while True:
            inner = np.flatnonzero(self.feature[at] >= 0)
            if not len(inner):
                return self.value[at]
            node = at[inner]
            low = x[inner, self.feature[node]] <= self.threshold[node]
            at[inner] = np.where(low, self.left[node], self.right[node])


def grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int, leaf: int) -> Tree:
    """A tree on a bootstrap sample; every split looks at a random part of the features."""
    nodes: list[list] = []
    tried = max(1, int(math.sqrt(x.shape[1])))

    def split(rows: np.ndarray, level: int) -> int:
        me, ones = len(nodes), float(y[rows].mean())
        nodes.append([-1, 0.0, -1, -1, ones])
        if level == depth or len(rows) < 2 * leaf or ones in (0.0, 1.0):
            return me
        best = (1e-12, -1, 0.0)
        impurity = ones * (1 - ones) * len(rows)
        for k in rng.permutation(x.shape[1])[:tried].tolist():
            order = np.argsort(x[rows, k], kind="stable")
            values, labels = x[rows[order], k], y[rows[order]]
            n = np.arange(1, len(rows))
            left = np.cumsum(labels)[:-1]
            right = left[-1] + labels[-1] - left
            gain = impurity - left * (1 - left / n) - right * (1 - right / (len(rows) - n))
            gain[(values[1:] == values[:-1]) | (n < leaf) | (len(rows) - n < leaf)] = -1
            at = int(np.argmax(gain))
            if gain[at] > best[0]:
                best = (float(gain[at]), k, float((values[at] + values[at + 1]) / 2))
        if best[1] < 0:
            return me
        low = x[rows, best[1]] <= best[2]
        nodes[me][0], nodes[me][1] = best[1], best[2]
        nodes[me][2] = split(rows[low], level + 1)
        nodes[me][3] = split(rows[~low], level + 1)
        return me

    split(rng.integers(0, len(y), len(y)), 0)
    columns = list(zip(*nodes, strict=True))
    kinds = ("i4", "f8", "i4", "i4", "f8")
    return Tree(*(np.array(c, dtype=k) for c, k in zip(columns, kinds, strict=True)))


@dataclass
class Forest:
    trees: list[Tree]

    def scores(self, found: Sequence[Finding]) -> np.ndarray:
        if not found:
            return np.empty(0)
        x = np.array([describe(f) for f in found])
        return np.mean([t.predict(x) for t in self.trees], axis=0)


def train_forest(
    labelled: Sequence[tuple[Finding, bool]], trees: int = 60, depth: int = 12, leaf: int = 2,
    seed: int = 11,
) -> Forest:
    """A forest from labelled findings; needs both kinds."""
    x = np.array([describe(f) for f, _ in labelled])
    y = np.array([float(label) for _, label in labelled])
    if len(set(y)) < 2:
        raise ValueError("Findings of both kinds are needed")
    rng = np.random.default_rng(seed)
    return Forest([grow(x, y, rng, depth, leaf) for _ in range(trees)])


def labelled_findings(count: int = 4000, seed: int = 5) -> list[tuple[Finding, bool]]:
    """Findings with known answers, made from public formats of keys and look-alikes.

    Stands in for a team's own reviewed findings, which have the same form. A secret in a
    path of tests, or a placeholder, counts as a false positive.
    """
    rng = random.Random(seed)
    alnum = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"

    def some(chars: str, *sizes: int) -> str:
        return "".join(rng.choice(chars) for _ in range(rng.choice(sizes)))

    hexes, digits = "0123456789abcdef", "0123456789"
    words = sorted(DICTIONARY)

    def prose(n: int) -> str:
        # Texts are in any language; most of their words are in no list.
        made = ["".join(rng.choice(["an", "er", "de", "lo", "ti", "sch", "qu", "ou", "en", "ra"])
                for _ in range(rng.randint(1, 4))) for _ in range(n)]
        line = " ".join(rng.choice(words) if rng.random() < 0.3 else w for w in made)
        return line.upper() if rng.random() < 0.1 else line

    def key() -> str:
        return rng.choice(
            [
                lambda: some(hexes, 32, 40, 40, 48, 64),
                lambda: some(hexes.upper(), 32, 40, 40, 64),
                lambda: some(alnum, 20, 24, 32, 40, 64),
                lambda: some(alnum + "+/", 40, 44, 64) + rng.choice(["", "=", "=="]),
                lambda: some(alnum + "_-", 22, 32, 43),
            ]
        )()

    def typed() -> str:
        return rng.choice(
            [
                lambda: "AKIA" + some(alnum[:26] + digits, 16),
                lambda: "ghp_" + some(alnum, 36),
                lambda: "sk_live_" + some(alnum, 24),
                lambda: "xoxb-" + some(digits, 11) + "-" + some(alnum, 24),
                lambda: "AIza" + some(alnum + "_-", 35),
                lambda: "glpat-" + some(alnum, 20),
                lambda: "eyJ" + some(alnum, 33) + "." + some(alnum, 60) + "." + some(alnum, 43),
            ]
        )()

    names = (
        "token api_key apikey secret password access_token auth_token client_secret secret_key "
        "private_key aws_secret_access_key API_KEY SECRET TOKEN passwd webhook_secret x-api-key "
        "api-key access-key secret-key DB_PASS pass pwd credential"
    ).split()

    def assigned(value: str) -> str:
        name = rng.choice(names)
        mark = rng.choice(['"', '"', "'", ""])
        if rng.random() < 0.15:
            return f"Authorization: Bearer {value}"
        return f"{name}{rng.choice([' = ', '=', ': ', ':', ' => '])}{mark}{value}{mark}"

    def word() -> str:
        return rng.choice(words)

    def password() -> str:
        """What people choose and generators give: with signs that keys don't have."""
        signs = "!#$%&@*^?"
        if rng.random() < 0.5:
            return some(alnum + signs, 9, 11, 14, 18, 24) + some(signs, 1) + some(alnum, 3, 6)
        swapped = prose(1).capitalize() + word().translate(str.maketrans("aeios", "43105"))
        return swapped + some(signs, 1) + prose(1).capitalize() + some(signs + digits, 2, 3, 4)

    def short() -> str:
        """Values between the two least lengths."""
        lower = alnum[26:52]
        return rng.choice(
            [
                lambda: some(lower + digits, 5, 7, 9, 12) + some(digits, 1) + some(lower, 2),
                lambda: some(alnum, 5, 7, 9, 12) + some(digits, 1) + some(alnum, 2),
                lambda: (prose(1) + some(digits, 1, 2, 4) + prose(1)).ljust(8, "7"),
            ]
        )()

    def address(value: str) -> str:
        scheme = rng.choice(["postgres", "mysql", "https", "http", "redis", "amqp", "mongodb+srv"])
        user = rng.choice(["", "app", "admin", "root", word()])
        port = rng.choice(["", ":5432", ":8080"])
        return f"{scheme}://{user}:{value}@{word()}{rng.choice(['', '.org', '.local'])}{port}/{word()}"

    def given(value: str) -> str:
        name = rng.choice(["", "", "DB_", "MY_DATABASE_", "app."]) + rng.choice(names)
        mark = rng.choice(['"', "'", "", ""])
        return f"{name}{rng.choice(['=', '=', ' = ', ': '])}{mark}{value}{mark}"

    def expression() -> str:
        return rng.choice(
            [
                lambda: f"{word()}.{word()}.{rng.choice(names)}",
                lambda: f"get_{word()}_{rng.choice(names)}({word()})",
                lambda: f"${{{word().upper()}_{rng.choice(names).upper()}}}",
                lambda: f"{{{{{word()}_{rng.choice(names)}}}}}",
                lambda: f"{word()}.environ[{word().upper()}]",
                lambda: f"${word()}->{word()}",
                lambda: f"{word()}{word().capitalize()}({word()})!",
            ]
        )()

    def uuid() -> str:
        return "-".join(some(hexes, n) for n in (8, 4, 4, 4, 12))

    def harmless() -> str:
        name = rng.choice(["sha1", "md5", "sha256", "checksum", "etag"])
        placeholder = rng.choice(
            [
                "your_api_key_here_1",
                "xxxxxxxxxxxxxxxx0000",
                "EXAMPLE" + some(digits, 12),
                "changeme12345678",
                "0000000000000000",
            ]
        )
        return rng.choice(
            [
                lambda: f"commit {some(hexes, 40)}",
                lambda: f"{name}: {some(hexes, 32, 40, 64)}",
                lambda: f"sha512-{some(alnum + '+/', 86)}==",
                uuid,
                lambda: some(digits, 16, 16, 19),
                lambda: " ".join(some(digits, 4) for _ in range(4)),
                lambda: f"{word()}.{some(digits, 2)}@{word()}{some(digits, 1)}.example.com",
                lambda: f"mail{some(digits, 1)}.{word()}.example.com",
                lambda: f"https://{word()}.org/{word()}/{some(hexes, 12, 40)}/{word()}.html",
                lambda: f"{word()}/{word()}/{word()}_{some(digits, 2)}.py",
                lambda: f"{word()}{word().capitalize()}{word().capitalize()}{some(digits, 1, 2)}",
                lambda: f"2024-01-1{some(digits, 1)}T1{some(digits, 1)}:30:00.{some(digits, 6)}Z",
                lambda: f"{word()}-{word()}-{some(digits, 1)}.{some(digits, 2)}.{some(digits, 1)}",
                lambda: f"data:image/png;base64,iVBORw0KGgo{some(alnum + '+/', 60)}",
                lambda: ".".join(some(digits, n) for n in (3, 3, 2, 3)) + "***",
                lambda: f"+1 ({some(digits, 3)}) {some(digits, 3)}-{some(digits, 4)}",
                lambda: assigned(placeholder),
                lambda: assigned(f"{word()}_{word()}_{some(digits, 1)}"),
                lambda: f"order {some(alnum[:26] + digits, 16)} id",
                lambda: given(expression()),
                lambda: given(expression()),
                lambda: given(word() + rng.choice(["", "_", "-"]) + word() + rng.choice(["", "...", "))"])),
                lambda: address(
                    rng.choice(
                        [
                            f"${{{word().upper()}_PASS}}",
                            "{" + word() + "_password}",
                            f"your_{word()}_password",
                            "changeme" + some(digits, 1, 3),
                            "xxxxxxxx",
                            "********",
                        ]
                    )
                ),
            ]
        )()

    paths = ["src/app/config.py", "deploy/prod.env", "lib/client.js", "web", "src3", "a.txt", ""]
    tests = ["tests/fixtures/keys.py", "docs/example.md", "src/test/mock.js", "examples/run.sh"]
    out: list[tuple[Finding, bool]] = []
    while len(out) < count:
        kind = rng.random()
        if kind < 0.26:
            core, label = assigned(key() if rng.random() < 0.75 else typed()), True
        elif kind < 0.33:
            core, label = given(password()), True
        elif kind < 0.38:
            core, label = given(short()), True
        elif kind < 0.42:
            value = rng.choice([key, password, short])().replace("/", "").replace("@", "")
            core, label = address(value), True
        elif kind < 0.48:
            core, label = typed(), True
        else:
            core, label = harmless(), False
        path = rng.choice(tests) if rng.random() < 0.12 else rng.choice(paths)
        if path in tests:
            label = False
        end = rng.choice(["", "", ".", ",", "!!", "###", "$$$", "&&&", "***"])
        text = f"{prose(rng.randint(0, 12))} {core}{end} {prose(rng.randint(0, 12))}"
        here = findings(text, path)
        if here:
            # Other runs of the line are look-alikes as well.
            inside = [f for f in here if f.value in core]
            for f in here:
                longest = max(inside, key=lambda g: len(g.value), default=None)
                out.append((f, label and f is longest))
    return out[:count]


@lru_cache(maxsize=1)
def default_forest() -> Forest:
    return train_forest(labelled_findings())


def scan(
    docs: DataFrame,
    forest: Forest | None = None,
    threshold: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
    path_col: str | None = "source",
) -> DataFrame:
    """One row per candidate of every whole text.

    Columns: identifier, start and end (characters), value, score (share of the forest's
    votes for a secret), is_secret. A null or empty text has no candidates; repeated rows
    give theirs each; a null path counts as none. Two candidates never overlap.
    """
    model = forest or default_forest()
    schema = "id long, start int, end int, value string, score double, is_secret boolean"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            place, found = [], []
            rows = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            for i, (text, path) in enumerate(rows):
                here = findings(text or "", path or "")
                place += [i] * len(here)
                found += here
            scores = model.scores(found)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(place, pa.int64())),
                    pa.array([f.start for f in found], pa.int32()),
                    pa.array([f.end for f in found], pa.int32()),
                    pa.array([f.value for f in found], pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(scores >= threshold, pa.bool_()),
                ],
                ["id", "start", "end", "value", "score", "is_secret"],
            )

    path = F.col(path_col).cast("string") if path_col else F.lit("")
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), path.alias("path")
    )
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def redact(
    docs: DataFrame,
    forest: Forest | None = None,
    threshold: float = 0.5,
    mark: str = "[SECRET]",
    text_col: str = "text",
    path_col: str | None = "source",
    size_col: str | None = "n_chars",
) -> DataFrame:
    """The rows and columns of ``docs`` with every secret replaced by ``mark``.

    ``size_col``, if the table has it, becomes the length of a text that changed. Texts
    without a secret, null ones included, stay as they are.
    """
    model = forest or default_forest()
    names = docs.columns
    text_at = names.index(text_col)
    path_at = names.index(path_col) if path_col in names else None
    size_at = names.index(size_col) if size_col in names else None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_at):
            texts = batch.column(text_at).to_pylist()
            paths = [""] * len(texts) if path_at is None else batch.column(path_at).to_pylist()
            here = [
                findings(t or "", str(p or "")) for t, p in zip(texts, paths, strict=True)
            ]
            scores = iter(model.scores([f for fs in here for f in fs]).tolist())
            changed = {}
            for i, found in enumerate(here):
                hidden = [f for f in found if next(scores) >= threshold]
                if hidden:
                    text = texts[i]
                    for f in reversed(hidden):
                        text = text[: f.start] + mark + text[f.end :]
                    changed[i] = texts[i] = text
            columns = list(batch.columns)
            columns[text_at] = pa.array(texts, columns[text_at].type)
            if size_at is not None and changed:
                sizes = columns[size_at].to_pylist()
                for i, text in changed.items():
                    sizes[i] = len(text)
                columns[size_at] = pa.array(sizes, columns[size_at].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return map_rows(docs, run)
