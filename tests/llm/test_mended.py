"""Rule versions of the ledger, markup as browsers read it, runs of licence texts and unmarked pages against brute force."""

from __future__ import annotations

import random
import re
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from crawldelta.llm import html_text, langid, licenses, secrets
from crawldelta.llm.scratch import new_folder
from tests.llm.test_operators import rows

# ---------------------------------------------------------------- 1 secrets


def test_spans_of_retired_versions_are_not_told(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "0123456789abcdef" * 3 + " token=abcdefgh1"), (2, None), (1, "plain")], "doc_id long, text string")
    ledger = new_folder(spark, "versions")
    told = lambda: {(r.doc_id, r.spans) for r in secrets.secret_report(docs, ledger).collect()}
    both = {(1, "hex:0:48,assign:49:64"), (1, ""), (2, "")}
    assert told() == both
    monkeypatch.setitem(secrets.RULES, "hex", (2, "finds less"))
    monkeypatch.setitem(secrets.FINDERS, "hex", lambda text: iter(()))
    # The workers have the finder of the first version; the ledger is told what the second one finds.
    scanned = [({"blob_id": bytes(r.blob_id), "rules": ["hex@2"], "spans": []}) for r in secrets.read_ledger(spark, ledger).collect()]
    spark.createDataFrame(scanned, f"blob_id binary, rules array<string>, spans {secrets._HELD}").write.mode("append").parquet(ledger)
    assert secrets.update_ledger(docs, ledger) == 0
    assert told() == {(1, "assign:49:64"), (1, ""), (2, "")}
    monkeypatch.undo()
    assert told() == both


def test_known_blobs_are_not_scanned_or_shuffled_again(spark):
    docs = spark.createDataFrame([(i, f"token=abcdefgh{i % 3}") for i in range(30)], "doc_id long, text string")
    ledger = new_folder(spark, "known")
    assert secrets.update_ledger(docs, ledger) == 3
    more = docs.unionByName(spark.createDataFrame([(50, "token=abcdefghx")], "doc_id long, text string"))
    assert secrets.update_ledger(more, ledger) == 1
    plan = secrets.scan_versions(more, ledger, ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange hashpartitioning\([^)]*text", plan)
    kept = secrets.scan_versions(more.withColumn("spans", F.lit("x")).withColumn("rule", F.lit(1)), ledger)
    assert kept.columns == ["doc_id", "text", "rule", "spans"] and kept.count() == 31


# ---------------------------------------------------------------- 2 html


@pytest.mark.parametrize("source", [
    "<p " + "a" * 100_000, "<p " + "a " * 50_000, "<p " + "a=" * 50_000, "<p " + "='" * 50_000, "<div>" * 8_000 + "</p>" * 8_000, "<div " + " " * 100_000,
    "<b" * 50_000, "<article>" * 5_000 + "</div>" * 5_000, "<p class=" + "x-" * 50_000 + ">", "<i x=1>" * 20_000, "<" * 100_000, "<!--" * 25_000, "&" * 100_000,
])
def test_long_markup_takes_linear_time(source):
    begin = time.process_time()
    html_text.read_page(source)
    assert time.process_time() - begin < 2


def article_of(source):
    page = html_text.read_page(source)
    return page.article if page.has_article else page.open_blocks


@pytest.mark.parametrize("tag", ['<p data-x=5">', "<p class=it's>", "<p 'x>", '<p a"b=c>', "<p title='a>b' x=\"c>d\">", "<p a = 'b'>", "<p a=b'c d=e\"f>", "<p / a/=b>"])
def test_quotes_open_values_only_after_an_equals_sign(tag):
    assert article_of(f"<article>{tag}text</p><p>more</p></article><nav>no</nav>") == ["text", "more"]


@pytest.mark.parametrize("attr,seen", [("role='main'", True), ("role=main", True), ('ROLE="Main"', True), ('data-role="main"', False), ('x=\'role="main"\'', False)])
def test_role_main_is_an_attribute(attr, seen):
    assert html_text.read_page(f"<div {attr}><p>text</p></div>").has_article is seen


@pytest.mark.parametrize("attr", ['class="social-history"', 'id="alert-fatigue"', 'class="skip-lists intro"', 'id="related-work"', 'class="header-files"', 'class="menu-costs"'])
def test_names_within_an_article_must_say_nothing_else(attr):
    assert article_of(f"<article><section {attr}><p>text</p></section></article>") == ["text"]


@pytest.mark.parametrize("attr", ['class="comments"', 'class="x ad"', 'id="related-posts"', 'class="share_buttons"', 'class="user-comments-section"', 'class="newsletter-signup-form"', 'class="comment-list"'])
def test_names_within_an_article_that_say_so(attr):
    assert article_of(f"<article><p>text</p><section {attr}><p>no</p></section></article>") == ["text"]


def test_given_pages_without_their_article_tags(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plain = pages.withColumn("html", F.regexp_replace("html", "(</?)article", "$1div"))
    data = plain.collect()
    least, streams, hosts = html_text.LEAST_TOKENS, {}, defaultdict(list)
    for r in data:
        page = html_text.read_page(r.html)
        assert not page.has_article
        streams[r.page_id] = " ".join(page.open_blocks).split(" ")
        hosts[re.match(r"[a-z]+://([^/?#]*)", r.url)[1].lower()].append(r.page_id)
    want = {}
    for own in hosts.values():
        held = defaultdict(set)
        for p in own:
            for i in range(len(streams[p]) - least + 1):
                held[tuple(streams[p][i : i + least])].add(p)
        for p in own:
            gone = [False] * len(streams[p])
            for i in range(len(streams[p]) - least + 1):
                if len(held[tuple(streams[p][i : i + least])]) > 1:
                    gone[i : i + least] = [True] * least
            want[p] = " ".join(t for t, g in zip(streams[p], gone) if not g).strip()
    got = {r.page_id: r.text for r in html_text.extract(plain).collect()}
    assert got == want and any(len(t.split(" ")) < len(streams[p]) for p, t in want.items())


def test_runs_of_most_texts_match_brute_force():
    rng = random.Random(5)
    for n in (0, 1, 2, 7):
        texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 30))) for _ in range(n)]
        for least in (1, 3, 5):
            held = [{" ".join(t.split(" ")[k : k + least]) for k in range(len(t.split(" ")) - least + 1)} for t in texts]
            got = html_text.common_runs(texts, least)
            assert sorted(got) == sorted(r for r in set().union(*held) if 2 * sum(r in h for h in held) > n)


@pytest.mark.parametrize("bound,together", [(html_text.SEGMENT_TOKENS, html_text.TOGETHER), (60, html_text.TOGETHER), (html_text.SEGMENT_TOKENS, 3), (60, 3)])
def test_marked_articles_lose_the_blocks_of_their_site(spark, bound, together, monkeypatch):
    monkeypatch.setattr(html_text, "TOGETHER", together)
    notice = "read our letter of the week with all that readers liked"
    body = lambda i: " ".join(f"own{i}x{k}" for k in range(20))
    page = lambda *blocks: f"<article>{''.join(f'<p>{b}</p>' for b in blocks)}</article>"
    data = [(i, f"http://a.example/{i}", page(body(i), notice, f"end {i}")) for i in range(12)]
    data += [(20 + i, f"http://a.example/{20 + i}", page(body(20 + i), f"they said: {notice}")) for i in range(3)]
    # On less than half of the pages, on few pages, on copies of one article, and in articles that are little else, it is text.
    data += [(30 + i, f"http://b.example/{i}", page(body(30 + i), notice if i < 6 else "")) for i in range(12)]
    data += [(50 + i, f"http://c.example/{i}", page(body(50 + i), notice)) for i in range(9)]
    data += [(60 + i, f"http://d.example/{i}", page(body(60 + max(i, 20)), notice)) for i in range(24)]
    data += [(90 + i, f"http://e.example/{i}", page(f"{i} again", notice, body(99))) for i in range(12)]
    data += [(0, *data[0][1:])]
    want = {i: f"{body(i)} end {i}" for i in range(12)} | {20 + i: f"{body(20 + i)} they said: {notice}" for i in range(3)}
    want |= {30 + i: f"{body(30 + i)} {notice}" if i < 6 else body(30 + i) for i in range(12)} | {50 + i: f"{body(50 + i)} {notice}" for i in range(9)}
    want |= {60 + i: f"{body(60 + max(i, 20))} {notice}" for i in range(24)} | {90 + i: f"{i} again {notice} {body(99)}" for i in range(12)}
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    found = html_text.extract(pages.repartition(3), segment_tokens=bound).collect()
    assert {r.page_id: r.text for r in found} == want and len(found) == len(data)


# ---------------------------------------------------------------- 4 licences


def plain_form(text):
    low = "\n".join(re.sub(licenses.COPYRIGHT_LINE, " ", line) for line in re.split(r"\r?\n", text.lower()))
    flat = " ".join(w for w in re.split(r"[\W_]+", low) if w)
    for pattern, instead in licenses.SPELLINGS:
        flat = re.sub(pattern, instead.replace("$", "\\"), flat)
    return flat


def test_runs_match_brute_force(spark):
    rng = random.Random(4)
    bodies = {k: licenses._body(t) for k, t in licenses.whole_texts()}
    short = ["MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "LGPL-3.0-only"]
    words = lambda n: " ".join(rng.choice("the permission gnu license redistribution of and copyright x1".split()) for _ in range(n))
    data = []
    for i in range(60):
        parts = [words(rng.randint(1, 30))]
        for _ in range(rng.randint(0, 3)):
            body = bodies[rng.choice(short)]
            kind = rng.random()
            if kind < 0.3:
                body = body[: rng.randint(40, len(body) - 40)]
            elif kind < 0.5:
                body = " ".join(body.split())
            elif kind < 0.7:
                body = body.replace("\n", "\r\n * ").upper()
            parts += [body, words(rng.randint(1, 30))]
        data.append((i % 50, rng.choice([" ", "\n", "\n\n"]).join(parts)))
    data += [(100, "x " + " ".join(bodies["MIT"].split()) + " y"), (101, "\n".join(" ".join(bodies["ISC"].split()) for _ in range(3))), (102, None), (103, "")]
    wholes = {k: {plain_form(t) for n, t in licenses.whole_texts() if n == k} | {plain_form(bodies[k])} for k in bodies}
    want = defaultdict(int)
    for doc_id, text in data:
        form = f" {plain_form(text or '')} "
        for k, body in bodies.items():
            sought = f" {plain_form(body)} "
            n = sum(form.startswith(sought, i) for i in range(len(form)) if form[i] == " ")
            lines = sum(plain_form(line) in wholes[k] for line in re.split(r"\r?\n", text or ""))
            own = max(lines, int(form.strip() in wholes[k]))
            if n > own:
                want[doc_id, k] += n - own
    found = licenses.license_matches(spark.createDataFrame(data, "doc_id long, text string")).where("scope = 'run'")
    assert rows(found.select("doc_id", "license_id", "n_units")) == sorted(((*k, n) for k, n in want.items()), key=repr) and len(want) > 20


def test_licenses_join_no_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = licenses.license_matches(docs)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


# ---------------------------------------------------------------- 5 languages


def test_any_number_of_labels(spark):
    rng = random.Random(5)
    common = {lang: [f"{lang}{rng.choice('abcdefgh')}{rng.choice('xyz')}" for _ in range(40)] for lang in ("en", "de")}
    text = lambda lang: " ".join(rng.choice(common[lang]) for _ in range(30))
    data = [(i, text("en" if i % 2 else "de"), "en" if i % 2 else "de", "s") for i in range(60)]
    data += [(100 + i, f"q{i}", f"label{i:03d}", "s") for i in range(300)] + [(999, None, None, None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string").repartition(4)
    langs, table = langid.train_text(docs)
    assert len(langs) == langid.MOST_LANGUAGES and langid.REST in langs and {"en", "de"} <= set(langs) and table.shape == (langid.PAIRS, len(langs))
    got = {r.doc_id: r.text_lang for r in langid.identify(langid.document_rows(docs), langs, table).collect()}
    assert len(got) == len(data) and all(got[i] == ("en" if i % 2 else "de") for i in range(60))


def plain_posterior(rows, langs, table):
    """The evidence of every row multiplied out, host and domain counts without the row itself."""
    import numpy as np

    posts = []
    for r in rows:
        w = np.exp(langid.text_support(r["text"], table))
        posts.append(w / w.sum())
    whole = (np.sum(posts, 0) + 1) / (np.sum(posts) + len(langs))

    def given(name):
        values = sorted({r[name] for r in rows if r[name] is not None})
        counts = {v: sum(p for r, p in zip(rows, posts) if r[name] == v) for v in values}
        total = sum(counts.values(), np.zeros(len(langs)))
        return {v: np.log((c + langid.EVIDENCE_ADDED) / (total + langid.EVIDENCE_ADDED * len(values))) for v, c in counts.items()}

    evidence = {n: given(n) for n in ("declared", "suffix")}
    told = []
    for k, r in enumerate(rows):
        smooth = lambda n, wider: (n + langid.PRIOR_WEIGHT * wider) / (n.sum() + langid.PRIOR_WEIGHT)
        others = lambda key: np.maximum(sum((p for j, p in enumerate(posts) if rows[j][key] == r[key]), np.zeros(len(langs))) - posts[k], 0)
        prior = smooth(others("host"), smooth(others("domain"), whole))
        logs = langid.text_support(r["text"], table) + np.log(prior)
        for n in evidence:
            logs = logs + (evidence[n][r[n]] if r[n] is not None else 0)
        p = np.exp(logs - logs.max())
        told.append((r["doc_id"], langs[int(np.argmax(logs))], round(float((p / p.sum()).max()), 9)))
    return told


def test_fused_posterior_matches_a_plain_product(spark):
    import numpy as np

    rng = random.Random(6)
    langs = ["de", "en", "fr"]
    table = np.log(np.random.default_rng(6).dirichlet(np.ones(langid.PAIRS), 3).T + 1e-9).astype(np.float32)
    rows_ = []
    for i in range(80):
        host = rng.choice(["a.x.de", "b.x.de", "y.com", "z.fr", ""])
        rows_.append({"doc_id": i, "page_id": None, "text": rng.choice([None, "", "ab", "a b c d e f g"[: rng.randint(1, 13)], "longer text here"]), "is_page": False,
                      "declared": rng.choice([None, "de", "en"]), "host": host, "suffix": rng.choice([None, "de", "com"]), "domain": host[-5:]})
    ddl = "doc_id long, page_id long, text string, is_page boolean, declared string, host string, suffix string, domain string"
    frame = spark.createDataFrame([tuple(r.values()) for r in rows_], ddl).repartition(3)
    got = sorted((r.doc_id, r.lang, round(r.confidence, 9)) for r in langid.identify(frame, langs, table).collect())
    want = sorted(plain_posterior(rows_, langs, table))
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
    assert all(abs(x[2] - y[2]) < 1e-6 for x, y in zip(got, want))


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang IS NOT NULL")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = langid.train_text(docs.where(~held))
    told = langid.identify(langid.document_rows(docs.where(held)), *model).join(docs.select("doc_id", F.col("lang").alias("label")), "doc_id")
    found = told.agg(F.avg((F.col("lang") == F.col("label")).cast("double")).alias("right"), F.count("*").alias("n")).first()
    assert found.n > 100 and found.right > 0.9
