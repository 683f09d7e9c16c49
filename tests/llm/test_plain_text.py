"""Text of pages with references of the whole table, unclosed hidden elements and quoted attributes."""

import html

from pyspark.sql import functions as F

from chatloom.llm import warc


def test_references_and_unclosed_elements(spark):
    refs = "caf&eacute; &mdash; &hellip;&euro;&uuml; &amp;eacute; AT&T &nosuch; &copy 5 &eacutex &NotEqualTilde; a&b &lt;i&gt; &#233;&amp;&amp;#65; x&ampy &"
    want = {
        refs: html.unescape(refs), "a &amp;lt; &quot;b&quot;": 'a &lt; "b"', "one<script>var x = 1;": "one", "one<!-- two <p>three": "one", "one<style>p {}</style>two<STYLE a='>'>b": "onetwo",
        '<p title="a > b">text</p><i x=\'>\'>more</i>': "text\nmore", '<p title="open>kept</p>': "kept", "": "",
    }
    got = {r.t: r.p for r in spark.createDataFrame([(t,) for t in want], "t string").select("t", warc.plain_text(F.col("t")).alias("p")).collect()}
    assert got == want
