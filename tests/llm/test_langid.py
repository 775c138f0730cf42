"""The fusion of evidence against a plain version, with pages whose text alone would mislead."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from windrow.llm import langid

WORDS = {
    "en": "the cat and the dog of this house with many things that were there",
    "fr": "le chat et les chiens de cette maison avec des choses qui sont la",
    "de": "der hund und die katze in dem haus mit vielen dingen die dort sind",
    "ceb": "ang iring ug ang iro niini nga balay uban sa daghang mga butang nga",
}


def mixed(rng, lang, n):
    return " ".join(rng.choices(WORDS[lang].split(), k=n))


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(3)
    tags = {"en": ["en", "en-US", "EN"], "fr": ["fr"], "de": ["de", "de_AT"], "ceb": ["ceb"]}
    rows = [(i, mixed(rng, lang, 40), rng.choice(tags[lang])) for i, lang in enumerate(list(WORDS) * 12)]
    rows += [(99, None, "en"), (98, "x y", None), (97, "x y", "english"), (96, "x y", "")]
    found = langid.train(spark.createDataFrame(rows, "doc_id int, text string, lang string"))
    assert found.languages == ["ceb", "de", "en", "fr"]
    return found


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(6)
    out = []
    for lang, suffix in (("en", "com"), ("fr", "fr"), ("de", "de"), ("ceb", "ph")):
        for host in range(3):
            for _ in range(rng.randrange(3, 12)):
                # Some pages of a host are in another language, some declare a wrong one, some have hardly any text.
                own = lang if rng.random() < 0.85 else rng.choice(list(WORDS))
                said = rng.choice(["", f' lang="{own}"', f" lang='{own}-XX'", f" class=a lang={rng.choice(list(WORDS))}"])
                text = mixed(rng, own, rng.choice([0, 1, 1, 2, 5, 30]))
                url = f"http://h{host}.{lang}.example.{suffix}/{rng.randrange(99)}"
                out.append((len(out), url, f"<html{said}><script>der die das</script><p>{text}</p></html>"))
    # Hosts of one language, and pages of them whose few letters say next to nothing.
    for lang in WORDS:
        big = f"http://big.{lang}.example.{lang}/"
        out += [(len(out) + k, f"{big}{k}", f'<html lang="{lang}"><p>{mixed(rng, lang, 12)}</p>') for k in range(40)]
        out += [(len(out) + k, f"{big}x{k}", f"<html lang={lang}><p>{text}</p>") for k, text in enumerate(("zq", "qx", "xw"))]
    long = mixed(rng, "fr", 20_000)
    out += [(len(out), "https://User@long.example.fr:80/x", f"<p>{long}</p>"), (len(out) + 1, None, None), (len(out) + 2, "::", "")]
    out += [(5, out[5][1], out[5][2]), (None, out[7][1], "<html lang=xx><p>the"), (7, out[9][1], f"<html lang=fil>{mixed(rng, 'de', 9)}")]
    # A text without any trigram of one language more than of another: a tie of the likelihoods.
    return out + [(900, "http://h0.fr.example.fr/t", "<p>中文</p>"), (901, "http://new.example.xyz/t", "<p>中文</p>")]


def visible(html):
    for pattern in (r"(?s)<!--.*?-->", r"(?is)<(script|style)\b.*?</\1\s*>", r"<[^>]*>", r"&(#\d+|#[xX][0-9a-fA-F]+|\w+);"):
        html = re.sub(pattern, " ", html)
    return html


def plain(pages, model):
    """Votes by text, priors and claims without a page's own vote, Bayes' rule: in loops over pages and languages."""
    languages, rows = model.languages, []
    for key, url, html in pages:
        html = html or ""
        said = re.search(r"""(?i)<html[^>]*?\slang\s*=\s*["']?([a-z]{2,3})(?![a-z0-9])""", html)
        at = re.search(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", (url or "").lower())
        host = at[1] if at else "-"
        grams = langid.buckets(visible(html))
        sums = [float(sum(model.log_likelihood[i][g] for g in grams)) for i in range(len(languages))]
        scores = [x * min(len(grams), langid.EVIDENCE) / max(len(grams), 1) for x in sums]
        vote = max(range(len(languages)), key=lambda i: (scores[i], -i)) if len(grams) else None
        parts = host.split(".")
        rows.append(
            dict(key=key, host=host, domain=".".join(parts[-2:]), suffix=parts[-1], declared=said[1].lower() if said else "-",
                 n=len(grams), scores=scores, vote=vote)
        )
    votes = {level: Counter((r[level], r["vote"]) for r in rows) for level in ("host", "domain", "suffix", "declared")}
    whole = Counter(r["vote"] for r in rows)
    n_values = {level: len({r[level] for r in rows}) for level in ("suffix", "declared")}
    out = []
    for r in rows:
        own = lambda i: 1.0 if r["vote"] == i else 0.0
        at = lambda level, i: votes[level][r[level], i] - own(i)
        every = range(len(languages))
        prior = [whole[i] - own(i) + 1.0 for i in every]
        prior = [x / sum(prior) for x in prior]
        for level, weight in (("domain", langid.DOMAIN_WEIGHT), ("host", langid.HOST_WEIGHT)):
            total = sum(at(level, i) for i in every)
            prior = [(at(level, i) + weight * prior[i]) / (total + weight) for i in every]
        log = []
        for i in every:
            others = whole[i] - own(i)
            claims = [(at(x, i) + langid.SMOOTHING) / (others + langid.SMOOTHING * n_values[x]) for x in ("declared", "suffix")]
            log.append(math.log(prior[i]) + sum(map(math.log, claims)) + r["scores"][i])
        best = max(every, key=lambda i: (log[i], -i))
        chance = 1 / sum(math.exp(x - log[best]) for x in log)
        text = None if r["vote"] is None else languages[r["vote"]]
        out.append((r["key"], languages[best], chance, text, r["declared"], r["suffix"], r["host"], r["n"]))
    return out


def test_fusion_of_every_page(spark, model, pages, monkeypatch):
    monkeypatch.setattr(langid, "PAGES_IN_TASK", 20)
    table = spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(3)
    table = table.withColumn("host", F.lit("own")).withColumn("scores", F.lit("own"))
    found = langid.identify(table, model)
    order = lambda r: (r[0] is None, r[0] or 0, r[7], repr(r[3:7]))
    got, want = sorted(map(tuple, found.collect()), key=order), sorted(plain(pages, model), key=order)
    assert [(*g[:2], *g[3:]) for g in got] == [(*w[:2], *w[3:]) for w in want]
    assert [g[2] for g in got] == [pytest.approx(w[2], rel=1e-9) for w in want]
    # Here the other evidence overrules the text, and where there is no text it decides.
    changed = [g for g in got if g[3] is not None and g[1] != g[3]]
    assert len(changed) >= 9 and len({g[1] for g in changed}) == 3 and any(g[3] is None and g[1] != "ceb" for g in got)
    tie = {g[0]: g for g in got if g[0] in (900, 901)}
    assert tie[900][1] == "fr"


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 2)
    rows = [(lang, "some words") for lang in ("en", "fr", "de")]
    with pytest.raises(ValueError, match="more than 2 languages"):
        langid.train(spark.createDataFrame(rows, "lang string, text string"))


def test_primary_part_of_declared_tags(spark):
    tags = {"fil": "fil", "en-US": "en", "zh_Hans": "zh", "english": "-", "x": "-", "CEB": "ceb", "de1": "-"}
    rows = [(said, f'<html class="a" lang="{said}">') for said in tags]
    table = spark.createDataFrame(rows, "said string, html string").select("said", langid.declared(F.col("html")).alias("found"))
    assert {r["said"]: r["found"] for r in table.collect()} == tags
