"""URL filtering by rules and by a logistic regression, in DataFrame expressions only.

Character n-grams of host and path are hashed into a fixed number of buckets; the bucket
weights are fitted by full-batch gradient descent on a small labelled table of URLs. Host and
path have buckets of their own. The fitted weights are one constant array of two times
``BUCKETS`` numbers, so scoring a URL needs neither a join nor a shuffle.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.staging import staged

BUCKETS = 16384
GRAMS = (3, 4, 5)
#: How much the path counts against the host.
PATH_SHARE = 0.5
#: Rules are part of the plan; more of them belong into a table that is joined.
MOST_RULES = 1000
#: Labelled URLs a model is fitted on, about.
MOST_LABELLED = 100_000


@dataclass(frozen=True)
class Rule:
    """Holds for a host with its subdomains and for paths with this beginning."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: Fixed values of the query: the rules the pages are judged by.
RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)

#: Words of unwanted and of ordinary hosts in the small labelled table, listed by hand. Ordinary
#: ones are words of several languages and none is a host of the pages; some hold pieces of
#: unwanted words.
UNWANTED = """
ad ads adserver adclick advert banner popup popunder tracker tracking track pixel beacon click clicks clickbait affiliate
casino poker roulette blackjack slots jackpot bet bets betting bookmaker wager lottery gamble gambling bingo
loan loans payday lender credit-fix debt-relief cash-advance quick-cash easy-money forex-robot crypto-double
pill pills cheap-meds pill-store pharmacy-deal viagra cialis steroids weight-loss diet-trick adult xxx porn sex nude escort hookup webcam-girls
spam scam phishing malware spyware keylogger ransomware crack warez keygen torrents serials no-deposit spins
win-prize winner-claim giveaway-now sweepstakes replica fake-watch counterfeit miracle-cure
""".split()
ORDINARY = """
blog news docs wiki forum library school museum garden recipes travel science music city weather theatre history nature
university hospital railway bakery kitchen football chess cinema poetry novel painting physics biology chemistry algebra
geometry astronomy planets rivers mountains forest harbour island village castle bridge station airport market grocery
furniture carpenter plumber electric energy solar windmill battery engine bicycle motorcycle insurance savings teacher
students courses lessons language grammar dictionary translation letters archive journal magazine newspaper podcast radio
television camera photos gallery design fashion clothing shoes jewelry toys children family parents wedding health doctor
dentist nurse clinic medicine fitness yoga running swimming hiking camping fishing sailing horses animals birds flowers
vegetables fruit coffee chocolate cheese bread wine beer restaurant hotel hostel tourism tickets events calendar maps
government parliament council police court justice law notary bank finance economy trade industry factory software hardware
computer network database server cloud mobile phone support help contact about careers jobs community charity church
schule zeitung wetter bahnhof garten kirche rathaus verein stadt kinder bilder musik wissenschaft handwerk sprache haus
escuela noticias cocina viajes historia salud deporte libros ciudad trabajo empresa mercado playa montana familia
ecole journal cuisine voyage sante livre ville travail marche plage montagne famille musee jardin maison ferme
download uploads reading roadside shadow headset leads badge adopt address admin adventure advice betony better alphabet
bethany winter windows twin classic essex sussex spectrum pillar pillow caterpillar loanword trackside racetrack
clicker adulthood scampi banners-museum cashmere credits lottie bingen tortoise wagering-law betterment beads threads
orchard ocean opera oak olive onion otter owl pine panda paper parade pebble pepper piano pilgrim planet pottery prairie
puzzle rabbit rainbow ranger ribbon river robin rocket rose saddle salmon scholar seagull shepherd sketch slate sleigh
snow sparrow spoon squirrel statue stove string sugar sunset swan tailor tapestry temple tennis thistle thunder tiger
tulip turtle umbrella valley vanilla velvet violin volcano voyage walnut waterfall whale willow window wizard wool
kayak knitting lantern ladder lighthouse marble meadow mill mirror moss needle nest oboe bagpipe barn basket beacon-hill
""".split()
#: What stands beside a word: unwanted names are mixed with each other and with the bait.
BAIT = "super best top online now hot vip bonus deal 24 zone mega real live".split()
PLAIN = "my the online center house group world team project land society union club info".split()
LANGUAGES, ENDINGS = ("en", "de", "fr", "es", "it"), ("com", "net", "org", "info", "io", "de", "co.uk", "test")
LEADS = ("", "www.", "m.", "blog.", "shop.")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """A small labelled table ``url, label`` (1: unwanted) spelled out from the word lists.

    Each word stands as host, as plural, with a hyphen and joined in front of and behind
    another word, an unwanted one also beside ordinary ones, and in the path of a plain host.
    Languages, numbers, endings, beginnings and page names occur under both labels, so they
    carry little weight.
    """
    rows = []
    for label, words, beside in ((1, UNWANTED, BAIT), (0, ORDINARY, PLAIN)):
        for i, word in enumerate(words):
            first, second = beside[i % len(beside)], beside[(5 * i + 3) % len(beside)]
            plural = word if word.endswith("s") else word + "s"
            names = [word, plural, f"{word}-{first}", f"{second}-{word}", f"{plural}-{second}"]
            names += [f"{first}{word}", f"{word}{second}"]
            if label:  # unwanted whatever stands beside it
                near, far = PLAIN[i % len(PLAIN)], PLAIN[(7 * i + 2) % len(PLAIN)]
                good, fine = ORDINARY[(11 * i) % len(ORDINARY)], ORDINARY[(17 * i + 5) % len(ORDINARY)]
                names += [f"{near}-{word}", f"{plural}-{far}", f"{far}{plural}", f"{word}{near}", f"{good}-{plural}", f"{word}-{fine}"]
            for k, name in enumerate(names):
                at = 3 * i + k
                middle = ("", "example.", "site.")[at % 3]
                tail = ("", ".html", "/", "/index", "?page=2")[(at // 2) % 5]
                host = f"{LEADS[(i + 2 * k) % 5]}{name}.{middle}{ENDINGS[(at + i) % 8]}"
                rows.append((f"https://{host}/{LANGUAGES[(i + k) % 5]}/{17 * at + 5}{tail}", label))
            plain = PLAIN[i % len(PLAIN)]
            rows.append((f"https://www.{plain}{i}.example.{ENDINGS[i % 4]}/{LANGUAGES[i % 5]}/{word}/{4000 + i}/", label))
    values = ", ".join(f"('{url}', {label})" for url, label in rows)
    return spark.sql(f"SELECT url, label FROM VALUES {values} AS t(url, label)")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def best_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest fitting rule as struct ``size, text, verdict``, or null."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    if not rules:
        return F.lit(None).cast("struct<size: int, text: string, verdict: string>")
    found = F.array(
        *(
            F.when(
                ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
                F.struct(
                    F.lit(len(r.text)).alias("size"),
                    F.lit(r.text).alias("text"),
                    F.lit(r.verdict).alias("verdict"),
                ),
            )
            for r in rules
        )
    )
    return F.array_max(found)


def with_grams(df: DataFrame, host: str, path: str, into: str) -> DataFrame:
    """Add a struct with the hashed n-grams ``host`` and ``path``, repeats included.

    Digits of the path are all taken for 0. The parts are taken apart into characters once,
    so the work is linear in their length; the last grams of a part are shorter.
    """
    plain = F.translate(path, string.digits, "0" * 10)
    df = df.withColumn("_host", F.split(F.concat(F.lit("^"), host, F.lit("$")), "")).withColumn(
        "_path", F.split(F.concat(F.lit("^"), plain, F.lit("$")), "")
    )

    def grams(chars: Column, n: int, field: int) -> Column:
        return F.transform(
            chars,
            lambda c, i: (
                F.pmod(
                    F.xxhash64(F.lit(8 * n + field), c, *(F.get(chars, i + k) for k in range(1, n))), F.lit(BUCKETS)
                )
                + field * BUCKETS
            ).cast("int"),
        )

    parts = [
        F.concat(*(grams(F.col(c), n, k) for n in GRAMS)).alias(c[1:]) for k, c in enumerate(("_host", "_path"))
    ]
    return df.withColumn(into, F.struct(*parts)).drop("_host", "_path")


def _scale(grams: Column, name: str) -> Column:
    """What a part's summed weights are divided by.

    The root of the number of grams; from 64 grams of a path on an eighth of the number, so
    that ordinary words do not add up along a long path.
    """
    n = F.size(grams[name])
    return F.sqrt(n) if name == "host" else F.greatest(F.sqrt(n), n / 8) / PATH_SHARE


def probability(grams: Column, weights: Sequence[float]) -> Column:
    """Logistic of the bias and the scaled sums of the weights of host and path.

    Each part has a scale of its own, so a long path does not dilute the host.
    """
    table = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")

    def part(name: str) -> Column:
        return F.aggregate(grams[name], F.lit(0.0), lambda sum_, g: sum_ + F.get(table, g)) / _scale(grams, name)

    return 1 / (1 + F.exp(-(F.get(table, F.lit(2 * BUCKETS)) + part("host") + part("path"))))


def training_sample(labelled: DataFrame, size: int = MOST_LABELLED) -> DataFrame:
    """About ``size`` rows of ``url, label``, as many of each label, chosen by a hash of the URL.

    A label that has fewer rows gives them all. Rows without label are left out.
    """
    known = labelled.where("label IS NOT NULL").select("url", "label")
    counts = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    place = F.pmod(F.xxhash64("url"), F.lit(1 << 30))
    share = F.lit(False)
    for label, count in counts.items():
        most = min(1.0, size / len(counts) / count)
        share |= (F.col("label") == label) & (place < F.lit(int(most * (1 << 30))))
    return known.where(share)


def fit(
    labelled: DataFrame, rounds: int = 20, rate: float = 0.7, decay: float = 0.01, size: int = MOST_LABELLED
) -> list[float]:
    """Weights of the buckets of hosts, of those of paths and, last, of the bias from ``url, label``.

    Full-batch gradient descent with a rate of its own for each bucket. Each round is one
    aggregation by bucket; what reaches the driver are at most ``2 * BUCKETS + 1`` sums.
    Weights of paths stay at 0 or above: a path may speak against a URL, but never clears a
    host. A table of more than ``size`` rows is sampled (:func:`training_sample`). Rows without
    label are left out; no rows give weights of zero.
    """
    host, path = split_url(F.col("url"))
    rows = training_sample(labelled, size).select(F.col("label").cast("double").alias("label"), host.alias("host"), path.alias("path"))
    bias = 2 * BUCKETS
    weights, seen = [0.0] * (bias + 1), [1e-9] * (bias + 1)
    with staged(with_grams(rows, "host", "path", "grams").select("label", "grams"), "labelled-urls") as known:
        for _ in range(rounds):
            off = known.select("grams", (F.col("label") - probability(F.col("grams"), weights)).alias("off"))
            grams = F.col("grams")
            parts = F.array(
                *(
                    F.struct(grams[name].alias("g"), (F.col("off") / _scale(grams, name)).alias("v"))
                    for name in ("host", "path")
                ),
                F.struct(F.array(F.lit(bias)).alias("g"), F.col("off").alias("v")),
            )
            sums = off.select(F.explode(parts).alias("p")).select(F.explode("p.g").alias("g"), "p.v").groupBy("g")
            for g, v in sums.agg(F.sum("v")).collect():
                v -= decay * weights[g]
                seen[g] += v * v
                weights[g] += rate * v / seen[g] ** 0.5
                if BUCKETS <= g < bias:
                    weights[g] = max(weights[g], 0.0)
    # rounded, so that the order in which tasks add up can't show
    return [round(w, 6) for w in weights]


def judge_urls(
    pages: DataFrame, labelled: DataFrame, rules: Sequence[Rule] = RULES, threshold: float = 0.5
) -> DataFrame:
    """Return ``page_id, host, path, rule, verdict, score`` for every row of ``pages``.

    The longest fitting rule decides, else the model: ``block`` where its score (the
    probability of label 1) reaches the threshold. Null or broken URLs have empty host and
    path and are judged by the model as such. Repeated rows are judged alike and kept, no
    rows give no rows; other columns are not read.
    """
    host, path = split_url(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    scored = with_grams(rows, "host", "path", "_grams").withColumn(
        "score", probability(F.col("_grams"), fit(labelled))
    )
    rule = best_rule(F.col("host"), F.col("path"), rules)
    return scored.withColumn("_rule", rule).select(
        "page_id",
        "host",
        "path",
        F.col("_rule.text").alias("rule"),
        F.coalesce(
            F.col("_rule.verdict"), F.when(F.col("score") >= threshold, "block").otherwise("allow")
        ).alias("verdict"),
        "score",
    )


# ----------------------------------------------------------------------- query


def query(spark, folder: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{folder}/pages.parquet"), labelled_urls(spark))
