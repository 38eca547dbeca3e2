"""Character references against the standard library."""

import html
import random

from actuspark.functions.entities import unescape
from actuspark.plans.text import article_text
from pyspark.sql import functions as F


def test_unescape(spark):
    rng = random.Random(3)
    names = [n.rstrip(";") for n in html.entities.html5]
    texts = ["", None, "plain", "&", "&&amp;amp;lt;", "&#0;&#x110000;&#xD800;&#128;&#159;&#13;&#1;", "&notit; &ltx &ampx; &hellip &nosuch; &#x41 &#65&#066;&#xfdd0;&#65534;&#x1F600;", "&#99999999999999;&#x000000000041;&#;&#x;", "&amp" * 3000]
    for _ in range(150):
        texts.append("".join(rng.choice([f"&{rng.choice(names)}", f"&#{rng.randrange(70000)}", f"&#x{rng.randrange(1200000):x}", "a b", "é"]) + rng.choice([";", "", " "]) for _ in range(rng.randint(1, 12))))
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    got = [r[0] for r in df.orderBy("k").select(unescape(F.col("t"))).collect()]
    bad = [(t, g) for t, g in zip(texts, got, strict=True) if g != (None if t is None else html.unescape(t))]
    assert bad == []


def test_article_text(spark):
    pages = [
        "<TITLE>A &amp; B</TITLE><script>var t='</p>'</script><main class=x>one<br/>two</main><article>no</article>",
        "<p>x</p><p>y &hellip;</p>",
        "<html><title></title><article></article>outside</html>",
        "",
        None,
    ]
    df = spark.createDataFrame(list(enumerate(pages)), "k int, t string")
    assert [r[0] for r in df.orderBy("k").select(article_text(F.col("t"))).collect()] == ["A & B\n\none\ntwo", "x\n y …", "\n\n", "", None]
