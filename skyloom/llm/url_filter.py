"""Operator 6 [native]: allow and block rules for urls, and a trained verdict for the rest.

The host is what stands after the first "://" up to "/", "?", "#" or the end
(A-Z lower-cased), the path goes on to "?", "#" or the end. The longest rule
that fits decides. Other urls are judged by logistic regression on hashed
character n-grams of host and path, trained on a small labelled url table.
Only DataFrame functions and JVM estimators are used.

Defined results: a null url, or one without "://", has an empty host and path
and no rule; its features are those of empty strings, and the model judges them
like any other.
"""

from __future__ import annotations

import json

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rules and labelled urls at most: both become part of the plan or of a driver-built table.
MAX_RULES = 1_000
MAX_LABELLED = 20_000
NGRAMS = (3, 4, 5)
FEATURES = 1 << 14

# The labelled urls. Hosts are two words with a hyphen, or one; no host of the tables that this is tried on is among them.
_BLOCK_WORDS = (
    "spam links|spammy seo|spam mail|bulk spam|bets online|best bets|sports bets|betting tips|casino royal|grand casino|casino bonus|slots casino|poker room|"
    "win jackpot|winbig lotto|win prizes|pills online|diet pills|herbal pills|pharma discount|cheap meds|cheap viagra|cheap watches|replica watches|payday loans|"
    "quick loans|ads server|ads click|popup ads|adclick zone|track pixel|click track|tracker hub|banner ads|adult video|adult cams|adult dating|xxx tube|porn tube|"
    "sexy cams|crypto giveaway|free iphone|free spins|free prizes|warez crack|keygen serials|torrent crack|phishing login|verify account|malware download|link farm|farm links|"
    "hot singles|escort girls|escorts vip|fake followers|buy followers|miracle cure|get rich|work fromhome"
).split("|")
_ALLOW_WORDS = (
    "daily news|local news|city news|science journal|physics notes|biology lab|chemistry today|open library|town library|library catalogue|museum guide|art museum|"
    "weather report|garden plans|farm museum|organic farm|family recipes|bread recipes|history society|travel notes|music school|theatre group|football club|cycling club|"
    "health service|nature reserve|astronomy club|housing council|city council|school board|open data|data archive|wiki pages|developer docs|code docs|book reviews|"
    "poetry corner|cinema guide|photo gallery|village fair|river trust|mountain rescue|harbour office|station clock|market hall|free software|public broadcasting|university press|"
    "winter sports|window makers|online encyclopedia|track athletics|pine forest|adriatic coast|linked maps|heritage trail|theology review|others stories|thread works|"
    "notation theory|motion study|tension lab|nation atlas|therapy centre"
).split("|")
# Everyday words, of which harmless hosts are made, and well-known harmless sites.
_EVERYDAY = (
    "account action advice animal answer apple arch art atlas autumn baker bank basket beach bell bird blue board boat bottle bread bridge bright brook build cabin camera camp candle card care carpet "
    "castle centre chair change chart choice church circle class clear click climate cloud coach coast coffee colour computer copper corner cotton craft credit crown dance data deep design desk "
    "dinner doctor door dream drive earth east engine estate evening event express fabric factory family farm field film fire fish flag flower forest forum frame friend fruit game gate gift glass "
    "gold grain green group guest hall hand harbour health heart hill home horse hotel house idea island job journey kitchen lake land language law leaf learn letter level library light link lion "
    "list local logic love machine mail map market master meadow media metal mind mirror money moon motor mountain music nature network night north note number ocean office online orange paper park "
    "partner path people phone photo piano picture place plan plant point post power press price project quick quiet radio rain reader red rest ring river road rock room rose safe salt school science "
    "sea season server shop silver sky smart snow social software song south space sport spring stage star station stone store stream street student studio style summer sun supply support system "
    "table tea team tech test time tool tour town track trade train travel tree trip trust valley video view village voice walk water wave web week west wind window wine winter wire wood word work world write"
).split()
_KNOWN = (
    "adobe.com stackoverflow.com spiegel.de clickhouse.com trackandfield.org wikipedia.org github.com python.org apache.org mozilla.org kernel.org debian.org gnu.org w3.org ietf.org bbc.co.uk "
    "nytimes.com lemonde.fr elpais.com zeit.de nature.com sciencemag.org nasa.gov noaa.gov who.int un.org europa.eu mit.edu stanford.edu ox.ac.uk ethz.ch arxiv.org archive.org gutenberg.org "
    "amazon.com ebay.com apple.com microsoft.com ibm.com intel.com oracle.com paypal.com visa.com reddit.com youtube.com vimeo.com flickr.com wordpress.com blogger.com medium.com imdb.com "
    "goodreads.com tripadvisor.com booking.com weather.com openstreetmap.org postgresql.org mysql.com docker.com npmjs.com rust-lang.org golang.org jquery.com"
).split()
_BLOCK_PATHS = ("/free-spins/bonus", "/buy-cheap/pills.html", "/click/track?aff=1", "/win-prize-now/", "/xxx/video/12", "/casino/bonus-code", "/aff/redirect/99", "/download/keygen.exe", "/payday-loans/apply", "/adult/cams/7")
_ALLOW_PATHS = ("/news/2021/04/story", "/articles/history-of-bridges", "/docs/manual.html", "/wiki/Rivers", "/about/contact", "/library/catalogue/12", "/blog/travel-notes", "/events/calendar", "/recipes/bread", "/research/papers/5")
_PLAIN_PATHS = ("/en/12", "/de/7.html", "/fr/345?page=2", "/es/98/", "/en/4021#top", "/", "")
#: Syllables of invented names, which are harmless; as in most crawls, harmless hosts are the greater part.
_SYLLABLES = "al an and ber con den el en er fin gar hal in ing ion jor kel lan mar nor ol on or per quin ran re sol st th the tor ul ver wil yar zen".split()
_INVENTED = 1_200
_SHAPES = (("https://", ".com"), ("http://www.", ".org"), ("https://blog.", ".net"), ("http://m.", ".example.com"), ("https://www.", ".example.org"), ("https://", ".example.net"))


def labelled_urls() -> list[tuple[str, int]]:
    """(url, 1 to block or 0 to allow), some 6,000 rows.

    Each host comes with plain paths, which say nothing, and with telling ones;
    paths that tell of spam are blocked on harmless hosts too.
    """
    found = []
    for words, label in ((_BLOCK_WORDS, 1), (_ALLOW_WORDS, 0)):
        for i, term in enumerate(words):
            for j, (scheme, ending) in enumerate(_SHAPES):
                host = f"{scheme}{term.replace(' ', '-' if j % 2 else '')}{ending}"
                found.append((host + _PLAIN_PATHS[(i + j) % len(_PLAIN_PATHS)], label))
                found.append((host + (_BLOCK_PATHS if label else _ALLOW_PATHS)[(i + j) % 10], label))
            if not label:
                found += [(f"https://www.{term.replace(' ', '-')}.org{_BLOCK_PATHS[(i + k) % 10]}", 1) for k in range(2)]
    for i, word in enumerate(_EVERYDAY):
        for k in (1, 7, 40, 111):  # pairs of everyday words, a dozen endings, plain and telling harmless paths
            scheme, ending = _SHAPES[(i + k) % len(_SHAPES)]
            other = _EVERYDAY[(i * 3 + k) % len(_EVERYDAY)]
            found.append((scheme + word + ("-" if (i + k) % 3 == 0 else "") + other + ending + (_PLAIN_PATHS[(i + k) % 7] if i % 2 else _ALLOW_PATHS[(i + k) % 10]), 0))
    for i, host in enumerate(_KNOWN):
        found += [(f"https://{host}{_PLAIN_PATHS[i % 7]}", 0), (f"https://www.{host}{_ALLOW_PATHS[i % 10]}", 0), (f"http://{host}{_BLOCK_PATHS[i % 10]}", 1)]
    n = len(_SYLLABLES)
    for i in range(_INVENTED):
        scheme, ending = _SHAPES[i % len(_SHAPES)]
        name = "".join(_SYLLABLES[x % n] for x in (i, 7 * i // n + 3, 11 * i // 5 + i // 97)[: 2 + i % 2])
        found.append((scheme + name + ending + (_PLAIN_PATHS[i % 7] if i % 3 else _ALLOW_PATHS[i % 10]), 0))
    return found


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def _cut(part: Column, mark: str) -> Column:
    """All n-grams of a text; its characters are split once, as substring() would count from the start for each."""

    def of(chars: Column) -> Column:
        end = F.size(chars)

        def grams(n: int) -> Column:
            gram = lambda c, i: F.when(i + n <= end, F.concat(F.lit(mark), c, *(F.get(chars, i + k) for k in range(1, n))))
            return F.filter(F.transform(chars, gram), lambda g: g.isNotNull())

        return F.concat(*map(grams, NGRAMS))

    return F.element_at(F.transform(F.array(F.regexp_extract_all(part, F.lit("(?s)."), F.lit(0))), of), 1)


def _grams(host: Column, path: Column) -> Column:
    """n-grams of the host and path, each marked with its part and its ends."""
    return F.concat(*(_cut(F.concat(F.lit("^"), part, F.lit("$")), mark) for mark, part in (("h", host), ("p", path))))


def _features(df: DataFrame, host: str, path: str) -> DataFrame:
    grams = df.withColumn("__grams", _grams(F.col(host), F.col(path)))
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="__grams", outputCol="__features").transform(grams).drop("__grams")


def train(spark: SparkSession, labelled: list[tuple[str, int]] | None = None) -> LogisticRegressionModel:
    """Fit on a labelled table of MAX_LABELLED rows at most."""
    rows = labelled_urls() if labelled is None else labelled
    if not 0 < len(rows) <= MAX_LABELLED:
        raise ValueError(f"the labelled table needs 1 to {MAX_LABELLED} rows, not {len(rows)}")
    table = F.from_json(F.lit(json.dumps([{"url": u, "label": float(y)} for u, y in rows])), "array<struct<url:string,label:double>>")
    urls = spark.range(1).select(F.explode(table).alias("r")).select("r.*")
    # both classes weigh the same
    share = sum(y for _, y in rows) / len(rows)
    weight = F.when(F.col("label") > 0, 0.5 / max(share, 1e-9)).otherwise(0.5 / max(1 - share, 1e-9))
    parts = urls.select("label", weight.alias("weight"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    fit = LogisticRegression(featuresCol="__features", labelCol="label", weightCol="weight", regParam=0.005, maxIter=40, standardization=False)
    return fit.fit(_features(parts, "host", "path").coalesce(1))


def _rule(host: Column, path: Column, rules: list[tuple[str, str]], what: int) -> Column:
    """The text (0) or verdict (1) of the longest rule that fits, else null."""
    chosen: Column | None = None
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + start)
        value = F.lit((rule, verdict)[what])
        chosen = F.when(fits, value) if chosen is None else chosen.when(fits, value)
    return F.lit(None).cast("string") if chosen is None else chosen


def judge(df: DataFrame, rules: list[tuple[str, str]], url_col: str = "url", model: LogisticRegressionModel | None = None, threshold: float = 0.5) -> DataFrame:
    """Add host, path, rule, p_block and verdict; other columns pass through (those of these names are replaced)."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; {MAX_RULES} at most")
    model = model or train(df.sparkSession)
    parts = df.withColumns({"host": host_of(df[url_col]), "path": path_of(df[url_col])})
    scored = model.setProbabilityCol("__p").setRawPredictionCol("__raw").setPredictionCol("__y").transform(_features(parts, "host", "path"))
    host, path, p = F.col("host"), F.col("path"), vector_to_array("__p")[1]
    return scored.withColumns(
        {
            "p_block": p,
            "rule": _rule(host, path, rules, 0),
            "verdict": F.coalesce(_rule(host, path, rules, 1), F.when(p >= threshold, "block").otherwise("allow")),
        }
    ).drop("__features", "__raw", "__p", "__y")
