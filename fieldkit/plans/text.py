"""Word counts, n-grams and chunks over whole documents (TX-*)."""

from __future__ import annotations

from fieldkit.functions import text as TXT
from fieldkit.operators import text as OT
from fieldkit.plans.catalog import register
from fieldkit.sources import fixtures as FX

WS = r"'[ \t\n\r\f]+'"
_TOKENS = f"list_filter(regexp_split_to_array(text, {WS}), lambda x: x <> '')"


@register("word_count_space", ids=("TX-1", "IO-5", "UD-4"), views=("corpus",), sql="""
    SELECT word, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM corpus)
    GROUP BY word""")
def word_count_space(spark, sf_dir):
    return OT.word_count(FX.corpus(spark, sf_dir), TXT.split_space("text"))


@register("word_count_ws", ids=("TX-2",), views=("corpus",), sql=f"""
    SELECT word, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest({_TOKENS}) AS word FROM corpus) GROUP BY word""")
def word_count_ws(spark, sf_dir):
    return OT.word_count(FX.corpus(spark, sf_dir), TXT.split_ws("text"))


@register("word_trigrams", ids=("TX-3",), views=("corpus",), sql=f"""
    WITH t AS (SELECT {_TOKENS} AS w FROM corpus),
         g AS (SELECT array_to_string(w[i:i + 2], ' ') AS ngram
               FROM (SELECT w, unnest(range(1, len(w) - 1)) AS i FROM t))
    SELECT ngram, CAST(count(*) AS BIGINT) AS n FROM g GROUP BY ngram""")
def word_trigrams(spark, sf_dir):
    return OT.ngram_count(FX.corpus(spark, sf_dir), TXT.split_ws("text"), 3)


@register("token_chunks", ids=("TX-4",), views=("corpus",), sql=f"""
    WITH t AS (SELECT doc_id, {_TOKENS} AS w FROM corpus)
    SELECT doc_id, CAST((i - 1) // 3 AS INTEGER) AS chunk_no, array_to_string(w[i:i + 2], ' ') AS chunk
    FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1, 3)) AS i FROM t)""")
def token_chunks(spark, sf_dir):
    return OT.token_chunks(FX.corpus(spark, sf_dir), "doc_id", TXT.split_ws("text"), 3)
