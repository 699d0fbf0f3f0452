"""Quality rules on languages that the table has too few documents of."""

from __future__ import annotations

from skyloom.llm import quality_rules
from skyloom.session import table

GOOD = {
    "zh": "我们 今天 在 城市 的 图书馆 里 看到 了 很多 新 书 ， 孩子 们 喜欢 听 老师 讲 故事 ， 然后 一起 回家 吃 晚饭 ， 天气 很 好 ， 大家 都 高兴 。",
    "pl": "Wczoraj poszliśmy do muzeum, gdzie przewodnik opowiadał o dawnych czasach, a dzieci słuchały z uwagą; później wróciliśmy pieszo przez park i zjedliśmy kolację w domu nad rzeką.",
    "ru": "Вчера мы ходили в музей, где экскурсовод рассказывал о старых временах, а дети слушали с вниманием; потом мы вернулись пешком через парк и поужинали дома у самой реки.",
}
JUNK = "$$$ 883 || ## 4411 %% << 99 >> && 120 ** 7 @@ 55 ~~ 31 ++ 8 == 12 {} 90 [] 4 $$ 1 ## 2 %% 3".replace("$$$", "$=$")


def test_unknown_languages(spark, sf_dir):
    known = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rows = [(-1 - i, text, lang) for i, (lang, text) in enumerate(GOOD.items())] + [(-11, JUNK, "zh"), (-12, JUNK, None), (-13, GOOD["ru"], None)]
    found = {r.doc_id: r for r in quality_rules.judge(known.union(spark.createDataFrame(rows, "doc_id long, text string, lang string")), keep=["doc_id"]).where("doc_id < 0").collect()}
    assert all(found[i].kept for i in (-1, -2, -3, -13)), found
    assert not found[-11].kept and not found[-12].kept and not found[-11].base_failed
