import hashlib
import random
import re
import time

from llm_fixtures import clashing, documents  # noqa: F401
from nightledger.llm.secret_scan import FIRST, SIGNS, _steps, log_ratios, scan_secrets, train, upper_bound

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found)]


def random_text(k):
    pick = random.Random(k)
    pieces = ["token", "TOKEN", "api_key", "apikey", "passwd", "secret", "=", ":", " ", "  ", '"', "'", "AKIA", "abc", "0123456789abcdef",
              "deadbeef" * 3, "ABCDEFGH12345678", "é", "🙂", ".", "-", "\n", "ſecret", "toKen", "x1y2z3"]
    return "".join(pick.choice(pieces) for _ in range(60))


def test_fixed_patterns_against_brute_force(documents, clashing):
    rows = [(k, random_text(k)) for k in range(150)]
    rows += [(200, None), (201, ""), (202, "passwd=token :abcdef"), (203, "token=secret=abcdef"), (204, "AKIA" * 8),
             (205, ("word " * 9 + "token=abcdef12 ") * 4000), (3, random_text(3)), (None, "token=abcdef")]
    found = scan_secrets(clashing(documents(rows))).collect()
    assert len(found) == len(rows)
    texts = dict(rows)
    for r in found:
        want = brute(texts[r.doc_id])
        base = [s for s in r.spans.split(",") if s and not s.startswith("markov")]
        assert base == want
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s.startswith(k) for s in want) for k in ("assign", "access", "hex")]


def test_models_find_what_no_pattern_names(documents):
    pick = random.Random(4)
    draw = lambda signs, n: "".join(pick.choice(signs) for _ in range(n))
    mixed = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    words = ["information", "configuration", "repository", "understanding", "international_relations", "maintenance-window"]
    rows = [(k, " ".join(pick.choice(words) for _ in range(40)) + f" token={draw(mixed, 30)} key") for k in range(300)]
    hidden = [(1000 + k, f"see internationalization {draw(mixed, 32)} and responsibilities-of-maintainers") for k in range(40)]
    found = {r.doc_id: r.spans for r in scan_secrets(documents(rows + hidden)).collect()}
    texts = dict(hidden)
    caught = 0
    for doc_id, text in texts.items():
        values = [text[int(a) : int(b)] for _, a, b in (s.split(":") for s in found[doc_id].split(",") if s)]
        caught += any(len(v) == 32 for v in values)
        assert not any("internationalization" in v or "responsibilities" in v for v in values)
    assert caught >= 28
    # Spans of the models do not touch those of the patterns.
    assert all("markov" not in found[doc_id] for doc_id, _ in rows)


def test_without_samples(documents):
    assert scan_secrets(documents([])).count() == 0
    only = scan_secrets(documents([(1, "Xk29dLq8Zt71MnB4Vc65 plain words")])).collect()
    assert only[0].spans == ""
    assert log_ratios({}) == [0.0] * SIGNS * SIGNS


def test_counts_and_bound_against_brute_force(documents):
    pick = random.Random(8)
    rows = [(k, " ".join(pick.choice(["wonderful", "configured_by", "sevenths", "under-stood"]) for _ in range(9))) for k in range(80)]
    rows += [(100, "password = 8fJ2kLq0Zx token:abcdef"), (101, "AKIA" + "Q7" * 9), (102, None)]
    counts = {}
    strings = [("8fJ2kLq0Zx", True), ("abcdef", True), ("AKIA" + "Q7" * 9, True)]
    strings += [(word, False) for _, text in rows[:80] for word in text.split()]
    for value, label in strings:
        for a, b in zip(value, value[1:]):
            step = (ord(a) - FIRST) * SIGNS + ord(b) - FIRST + 1
            counts[label, step] = counts.get((label, step), 0) + 1
    ratios, bound = train(documents(rows))
    assert ratios == log_ratios(counts)
    score = lambda v: sum(ratios[(ord(a) - FIRST) * SIGNS + ord(b) - FIRST] for a, b in zip(v, v[1:]))
    scores = sorted(max(0.0, score(value)) for value, label in strings if not label)
    exact = scores[int(0.99 * len(scores)) - 1]
    assert exact <= bound <= exact + 1 / 16 + 1e-9
    assert upper_bound({}) == 0.0 and upper_bound({0: 99, 40: 1}) == 0.0 and upper_bound({0: 98, 40: 2}) == 2.5


def test_one_secret_in_many_documents_is_enough(documents):
    """The models see all documents, however few of them name a secret."""
    pick = random.Random(5)
    draw = lambda n: "".join(pick.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnpqrstuvwxyz23456789") for _ in range(n))
    rows = [(k, "ordinary information about configuration and understanding") for k in range(10_000)]
    rows += [(20_000, "token=" + draw(400)), (20_001, f"see {draw(40)} there")]
    spans = {r.doc_id: r.spans for r in scan_secrets(documents(rows)).filter("spans != ''").collect()}
    assert spans[20_001] == "markov:4:44"


def test_a_long_run_takes_time_in_proportion(documents):
    pick = random.Random(6)
    run = "".join(pick.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=1 << 20))
    words = ["information", "configuration", "understanding", "responsible", "international"]
    plain = [(10 + k, " ".join(pick.choices(words, k=60))) for k in range(3000)]
    docs = documents([*plain, (1, f"token={run[:3000]} plain words about nothing"), (2, f"data:image/png;base64,{run} end")])
    begun = time.perf_counter()
    found = {r.doc_id: r.spans for r in scan_secrets(docs).collect()}
    assert found[2].startswith(f"markov:22:{22 + len(run)}") and time.perf_counter() - begun < 60


def test_steps(spark):
    rows = [("ab",), ("a",), ("",), ("zZ+-",)]
    found = {r.v: r.s for r in spark.createDataFrame(rows, "v string").filter("char_length(v) > 0").select("v", _steps("v").alias("s")).collect()}
    assert found == {v: [(ord(a) - FIRST) * SIGNS + ord(b) - FIRST + 1 for a, b in zip(v, v[1:])] for (v,) in rows if v}
