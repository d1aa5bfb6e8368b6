"""Personal data: base spans and disclosing terms against plain Python."""

import math
import re
from collections import Counter

import pytest

from strata.llm import disclosure
from strata.llm import queries as Q

from .edge_rows import frame, lower

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def luhn(digits):
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, digits[::-1]))) % 10 == 0


def brute_base(t):
    out = [("email", m.start(), m.end(), m[0]) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m.start(), m.end(), m[0]) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[^0-9]", "", m[0])
        out += [("card", m.start(), m.end(), m[0])] if 13 <= len(digits) <= 19 and luhn(digits) else []
    out += [("phone", m.start(), m.end(), m[0]) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def brute_more(rows, least=3, generalise_at=0.75, remove_at=0.9, reach=80):
    context, holders, df = [], {}, Counter()
    for r, (_, t) in enumerate(rows):
        t = t or ""
        df.update(set(TERM.findall(lower(t))))
        spans = sorted((a, b, f"{k}:{lower(v)}") for k, a, b, v in brute_base(t))
        for i, (a, b, e) in enumerate(spans):
            holders.setdefault(e, set()).add(r)
            lo = max([0, a - reach] + [y for _, y, _ in spans[:i]])
            hi = min([len(t), b + reach] + [x for x, _, _ in spans[i + 1:]])
            for m in TERM.finditer(lower(t[lo:a])) if lo < a else ():
                if not (a - lo == reach and m.start() == 0):
                    context.append((r, e, m[0], lo + m.start()))
            for m in TERM.finditer(lower(t[b:hi])) if b < hi else ():
                if not (hi - b == reach and m.end() == hi - b):
                    context.append((r, e, m[0], b + m.start()))
    context = [c for c in context if len(c[2]) >= 3 and re.search("[^0-9]", c[2])]
    beside = {}
    for r, e, t, _ in context:
        beside.setdefault((e, t), set()).add(r)
    n, action = len(rows), {}
    for (e, t), where in beside.items():
        if len(where) >= least and len(holders[e]) < n:
            share = math.log(n * len(where) / (len(holders[e]) * df[t])) / math.log(n / len(holders[e]))
            if share >= generalise_at:
                action[e, t] = "remove" if share >= remove_at else "generalise"
    more = [set() for _ in rows]
    best = {}
    for r, e, t, a in context:
        if (e, t) in action:
            best[r, a, a + len(t)] = max(best.get((r, a, a + len(t)), ""), action[e, t])
    for (r, a, b), kind in best.items():
        more[r].add((kind, a, b))
    return [sorted(m) for m in more]


CASES = ["", "a@b.c", "x@y a@b@c.com a.b+c%d@e-f.gh.ij. a@b.com_x@y.org,q@r.s-", "@@a@b..c a@.b a@b.c.", "1.2.3.4 256.1.1.1 001.02.255.0255 1.2.3 1.2.3.4.5.6.7.8", "9" * 4000 + "." + "1.2.3",
         "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111 4  1 12", "0000000000000 +4111111111111111", "+1 (555) 123-4567. +12 +1 2 +123456789012345 +1234567890123456 ++49 89 1234567 x", "é" * 90 + " a@b.cd " + "ü" * 90 + "😀 +49.89.123 456 7",
         "x" * 900, "a." * 400, "1 " * 400, "+1" + " ()" * 300, "a@b" + ".c" * 300, "\n a@b.c\n1.1.1.1\r\n"]


@pytest.fixture(scope="module")
def rows():
    """Two thirds hold no personal data, or only data of their own; the rest share an address that some terms give away."""
    out = list(enumerate(CASES)) + [(None, None), (None, "a@b.c"), (50, None), (51, ""), (51, "")]
    for i in range(12):
        out.append((100 + i, f"Mail Zarquon Beeble or Slartibart{i % 4} about the weather: zarquon@galaxy.example and the {'Magrathea9' if i < 11 else 'other'} weather is fine"))
    out += [(200 + i, f"the weather and plain words about number {i} and mail") for i in range(40)] + [(300, "Magrathea9 is far"), (301, "two magrathea9 words")]
    return out + [(400, "zarquon@galaxy.example zarquon@galaxy.example beeble +1 555 123 4567 beeble" + " far" * 40)] * 3


def test_spans_equal_brute_force(spark, rows):
    got = disclosure.personal_spans(frame(spark, rows)).collect()
    want = Counter()
    for (doc, t), more in zip(rows, brute_more(rows)):
        want[doc, tuple((k, a, b, v) for k, a, b, v in brute_base(t or "")), tuple(more)] += 1
    assert Counter((r["doc_id"], tuple((s["kind"], s["start"], s["end"], s["value"]) for s in r["spans"]), tuple((s["kind"], s["start"], s["end"]) for s in r["more"])) for r in got) == want
    kinds = Counter(k for _, _, more in want.elements() for k, _, _ in more)
    assert kinds["remove"] and kinds["generalise"]


def test_sanitised_texts_lose_every_span_and_keep_the_rest(spark, rows):
    df = frame(spark, rows)
    out = disclosure.sanitised(df)
    assert out.schema == df.schema or [f.name for f in out.schema] == df.columns
    want = Counter()
    for (doc, t), more in zip(rows, brute_more(rows)):
        spans = sorted([(a, b, k) for k, a, b, _ in brute_base(t or "")] + [(a, b, k) for k, a, b in more])
        runs = []
        for a, b, k in spans:
            if runs and a < runs[-1][1]:
                runs[-1] = (runs[-1][0], max(b, runs[-1][1]), runs[-1][2])
            else:
                runs.append((a, b, k))
        s, at = "", 0
        for a, b, k in runs:
            word = t[a:b]
            mark = "" if k == "remove" else f"[{k.upper()}]" if k != "generalise" else "[CODE]" if re.search("[0-9]", word) else "[NAME]" if word[0].isupper() else "[WORD]"
            s, at = s + t[at:a] + mark, b
        want[doc, t if not runs else s + t[at:]] += 1
    got = out.collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == want and all(r["tags"] == {"a": "b"} for r in got)


def test_long_documents_with_many_finds(spark):
    t = " ".join(f"user{i}@host{i % 7}.example 10.0.{i % 300}.1 word" for i in range(3000))
    got = disclosure.personal_spans(spark.createDataFrame([(1, t)], "doc_id bigint, text string")).first()
    assert [(s["kind"], s["start"], s["end"], s["value"]) for s in got["spans"]] == brute_base(t)


def test_long_runs_are_read_once(spark):
    texts = ["x" * 400_000, "a." * 200_000, "1 " * 200_000, "7" * 400_000, "+1" + " ()" * 100_000, "a@b" + ".c" * 100_000, "1." * 200_000, "@" * 400_000]
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in disclosure.personal_spans(frame(spark, enumerate(texts))).collect()}
    assert {k: v for k, v in got.items() if v} == {5: [("email", 0, 200_003)], 6: [("ip", 8 * i, 8 * i + 7) for i in range(50_000)]}


def test_empty_table_and_query_columns(spark, rows, tmp_path):
    assert disclosure.personal_spans(frame(spark, [])).count() == 0 and disclosure.sanitised(frame(spark, [])).count() == 0
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = Q.op11_personal_data(spark, str(tmp_path)).collect()
    mores = iter(brute_more(rows))
    want = Counter()
    for doc, t in rows:
        base, more = brute_base(t or ""), next(mores)
        n = Counter(k for k, *_ in base)
        want[doc, n["email"], n["ip"], n["card"], n["phone"], ",".join([f"{k}:{a}:{b}" for k, a, b, _ in base] + [f"{k}:{a}:{b}" for k, a, b in more])] += 1
    assert Counter((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["spans"]) for r in got) == want


def test_no_python_runs_on_the_main_path(spark, rows):
    from tests.conftest import plan_text

    assert not re.search("Python|Pandas|Arrow", plan_text(disclosure.personal_spans(frame(spark, rows))))


def test_terms_are_counted_before_they_are_joined(spark, tmp_path):
    """The join meets one row a term, in however many documents it occurs, also when the terms are few enough to be broadcast."""
    from tests.conftest import plan_text

    df = frame(spark, [(i, f"common word{i % 5} Common rare{i}") for i in range(50)] + [(None, None), (90, ""), (90, "")])
    spark.createDataFrame([("common",), ("word3",), ("rare7",), ("absent",)], "term string").write.parquet(f"{tmp_path}/terms")
    found = disclosure.document_frequencies(df, spark.read.parquet(f"{tmp_path}/terms"))
    assert {r["term"]: r["dt"] for r in found.collect()} == {"common": 50, "word3": 10, "rare7": 1}
    plan = plan_text(found, "simple")
    assert plan.index("Join") < plan.index("HashAggregate") < plan.index("Generate")


def test_whole_texts_are_cut_between_their_terms(spark, tmp_path):
    """Equal to the plain terms in every script and case; no whole text is folded by character or searched for terms, which filled the executors' heap."""
    from tests.conftest import plan_text

    texts = ["", " ", "\x00", "Ab", "aB ab AB a1", ",Ab--cD, ", "ÉCOLE École éCOLE É", "\u212aELVIN Kelvin kelvin", "İstanbul istanbul I", "Straße STRASSE ẞ", "a😀B A😀b 😀", "日本 日本,Z日 z日", "x[Y]^z_`{W}|~\x7fq@r/s:0", "Σας ΣΑΣ", "é\u0301A é", "tail\x80Ab", "A\tB\nC\r\n", "Ab" * 500 + " " + "é" * 500] + CASES
    df = frame(spark, [*enumerate(texts), (None, None), (None, "Ab é"), (3, "Ab")])
    want = Counter(t for text in [*texts, "Ab é", "Ab"] for t in set(TERM.findall(lower(text))))
    spark.createDataFrame([(t,) for t in want], "term string").write.parquet(f"{tmp_path}/terms")
    found = disclosure.document_frequencies(df, spark.read.parquet(f"{tmp_path}/terms"))
    assert {r["term"]: r["dt"] for r in found.collect()} == want
    plan = plan_text(found, "simple")
    assert "split(" in plan and "regexp_extract_all" not in plan and "translate(text" not in plan
