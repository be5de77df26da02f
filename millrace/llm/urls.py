"""URL filters: host rules, and trust spread over the host graph for the rest.

A host's links are its pages' links to other hosts; hosts of one domain are
also joined through it. Trust is a personalised PageRank from the hosts of
allowed pages along the links. Distrust starts at the hosts of blocked pages
and runs against the links: who links to a bad host is doubted. Both are kept
as one table of a row per host, and every round is a join and a sum in Spark.

A URL that is NULL or has no ``://`` has an empty host and path, fits no rule
and takes part in no link. Repeated pages count once per row as seeds, links
once per pair of hosts. Pages without a single edge keep the default verdict.
Of fitting rules the longest wins, of equally long ones the last listed. An empty table
gives an empty result. Other columns are kept; ``host``, ``path``, ``rule``, ``ruled``
and ``verdict`` of the input are replaced, ``ruled`` by nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Scratch, fresh, lower_ascii


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith(f".{self.host}")) & path.startswith(self.path)


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty without ``://``."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def apply_rules(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``host``, ``path``, ``rule`` and ``ruled`` (its verdict) of every page.

    The rules are a list of the program, tried from the longest: one projection.
    """
    host, path = split_url(F.col("url"))
    rule, ruled = F.lit(None).cast("string"), F.lit(None).cast("string")
    for item in sorted(rules, key=lambda r: len(r.text)):
        fits = item.fits(F.col("host"), F.col("path"))
        rule = F.when(fits, F.lit(item.text)).otherwise(rule)
        ruled = F.when(fits, F.lit(item.verdict)).otherwise(ruled)
    return pages.withColumns({"host": host, "path": path}).withColumns({"rule": rule, "ruled": ruled})


def host_links(pages: DataFrame) -> DataFrame:
    """Distinct ``src``, ``dst`` hosts of absolute links, and of hosts and their parent domain both ways."""
    targets = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(r"""(?i)href\s*=\s*["']?(?:https?:)?(//[^"'\s>]+)"""), F.lit(1))
    linked = pages.select(F.col("host").alias("src"), F.explode(F.array_distinct(targets)).alias("_url")).select(
        "src", split_url(F.concat(F.lit("http:"), F.col("_url")))[0].alias("dst")
    )
    parent = F.regexp_extract("host", r"^[^.]+\.([^.]+\..+)$", 1)
    family = pages.select("host", parent.alias("_parent")).where("_parent != ''").distinct()
    up = family.select(F.col("host").alias("src"), F.col("_parent").alias("dst"))
    down = family.select(F.col("_parent").alias("src"), F.col("host").alias("dst"))
    return linked.unionByName(up).unionByName(down).where("src != '' AND dst != '' AND src != dst").distinct()


def link_scores(
    links: DataFrame, seeds: DataFrame, rounds: int = 12, damping: float = 0.85, scratch: Scratch | None = None
) -> DataFrame:
    """``host``, ``trust`` and ``distrust`` of every host that is linked or a seed.

    ``seeds`` has ``host``, ``trust0`` and ``distrust0``, the shares of a jump
    that land there. Runs a job per round; each round is written to the shared folder.
    """
    scratch = scratch or Scratch(links.sparkSession, "urls")
    out_degree = links.groupBy("src").agg(F.count("*").alias("n_out"))
    in_degree = links.groupBy("dst").agg(F.count("*").alias("n_in"))
    weighed = links.join(out_degree, "src").join(in_degree, "dst")
    forward = weighed.select(F.col("src").alias("host"), F.col("dst").alias("to"), (1 / F.col("n_out")).alias("t"), F.lit(0.0).alias("d"))
    backward = weighed.select(F.col("dst").alias("host"), F.col("src").alias("to"), F.lit(0.0).alias("t"), (1 / F.col("n_in")).alias("d"))
    moves = forward.unionByName(backward).groupBy("host", "to").agg(F.sum("t").alias("t"), F.sum("d").alias("d"))
    moves = scratch.write("moves", moves)
    jump = seeds.select("host", (F.col("trust0") * (1 - damping)).alias("trust"), (F.col("distrust0") * (1 - damping)).alias("distrust"))
    scores = seeds.select("host", F.col("trust0").alias("trust"), F.col("distrust0").alias("distrust"))
    for _ in range(rounds):
        moved = moves.join(scores, "host").select(
            F.col("to").alias("host"),
            (F.col("t") * F.col("trust") * damping).alias("trust"),
            (F.col("d") * F.col("distrust") * damping).alias("distrust"),
        )
        summed = moved.unionByName(jump).groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
        scores = scratch.replace("scores", summed)
    return scores


def url_filter(
    pages: DataFrame, rules: Sequence[Rule] = RULES, rounds: int = 12, damping: float = 0.85, threshold: float = 1.0
) -> DataFrame:
    """The pages with ``host``, ``path``, ``rule`` and ``verdict``.

    A page without a rule is blocked where its host's distrust exceeds
    ``threshold`` times its trust, and allowed otherwise.
    """
    scratch = Scratch(pages.sparkSession, "urls")
    ruled = apply_rules(pages, rules)
    hosts = scratch.write(
        "hosts",
        ruled.where("host != ''").groupBy("host").agg(
            F.count_if(F.col("ruled") == "allow").alias("allowed"), F.count_if(F.col("ruled") == "block").alias("blocked")
        ),
    )
    sums = hosts.agg(F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked")).first()
    seeds = hosts.select(
        "host",
        (F.col("allowed") / float(sums["allowed"] or 1)).alias("trust0"),
        (F.col("blocked") / float(sums["blocked"] or 1)).alias("distrust0"),
    )
    scores = link_scores(host_links(ruled), scratch.write("seeds", seeds), rounds, damping, scratch)
    doubted = scratch.write("doubted", scores.where(F.col("distrust") > F.col("trust") * threshold).select("host"))
    (mark,) = fresh(ruled, "_doubted")
    verdicts = ruled.join(doubted.withColumn(mark, F.lit(True)), "host", "left")
    judged = F.when(F.col(mark), F.lit("block")).otherwise(F.lit("allow"))
    return verdicts.withColumn("verdict", F.coalesce("ruled", judged)).drop(mark, "ruled")
