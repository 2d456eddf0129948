"""Access policy, request pacing and retry outcomes, over tables of rules, URLs and attempts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import WHITESPACE
from ..functions.urls import url_host, url_origin
from ..session import materialize
from .skew import HOT_ROWS, with_blocks

# The statuses and failures worth another attempt.
RETRYABLE_STATUS = [429, 500, 502, 503, 504]
RETRYABLE_ERRORS = ["connection", "timeout"]
FIRST_ERROR_STATUS = 400

# Where an origin's policy file is, its fields, and what ends its lines.
POLICY_FILE = "/robots.txt"
AGENT_FIELD = "user-agent"
RULE_FIELDS = ["allow", "disallow"]
OTHER_FIELDS = ["crawl-delay", "request-rate"]
LINE_ENDS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\u0085\u2028\u2029]"

#: So many rules of an origin are brought together in one row.
FEW_RULES = 200


def _escaped(text: Column | str) -> Column:
    """Text whose every '%' begins an escape, and which has no '+' that would be read as a space."""
    return F.regexp_replace(F.replace(text, F.lit("+"), F.lit("%2B")), "%(?![0-9a-fA-F]{2})", "%25")


def _percent_encoded(text: Column) -> Column:
    """Decode, then encode everything but letters, digits, '_.-~' and '/'."""
    encoded = F.url_encode(F.url_decode(_escaped(text)))
    for plain, wanted in (("+", "%20"), ("*", "%2A"), ("%2F", "/"), ("%7E", "~")):
        encoded = F.replace(encoded, F.lit(plain), F.lit(wanted))
    return encoded


def policy_path(url: Column) -> Column:
    """Path, query and fragment, percent-encoded; '/' when empty. A path that begins with two slashes gets two more, as a host-less URL needs them."""
    rest = _percent_encoded(F.regexp_replace(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*", ""))
    return F.when(rest == "", "/").when(rest.startswith("//"), F.concat(F.lit("//"), rest)).otherwise(rest)


def policy_rules(pages: DataFrame) -> DataFrame:
    """The rules in policy files: origin, entry_no, agent, rule_no, path, allow.

    ``pages``: url, html; the file of an origin is its page /robots.txt, one per origin. A group begins at an agent line that does not follow
    another one; an empty line ends it. Comments go, names of fields count in any case, and numbers rise as the lines do. Rules before any agent
    do not count, nor do agents without anything after them; a group with a delay but no rule allows everything. Lines are brought together per
    file, which was one value before.
    """
    is_file = policy_path(F.col("url")) == POLICY_FILE
    lines = pages.where(is_file & F.col("html").isNotNull()).select(url_origin("url").alias("origin"), F.posexplode(F.split("html", LINE_ENDS)).alias("line", "raw"))
    text = F.trim(F.regexp_replace(F.regexp_replace("raw", "#.*", ""), WHITESPACE, " "))
    name = F.lower(F.trim(F.substring_index("text", ":", 1)))
    fields = lines.withColumn("text", text).withColumns({
        "name": F.when(F.col("raw") == "", "").when(F.contains("text", F.lit(":")), name),
        "value": F.trim(F.expr("substring(text, instr(text, ':') + 1)")),
    })
    kind = F.when(F.col("name") == "", "end").when(F.col("name") == AGENT_FIELD, "agent").when(F.col("name").isin(RULE_FIELDS + OTHER_FIELDS), "rule")
    known = fields.withColumn("kind", kind).where("kind IS NOT NULL")
    of_file = Window.partitionBy("origin").orderBy("line")
    begins = (F.col("kind") == "end") | (F.col("kind") == "agent") & F.coalesce(F.lag("kind").over(of_file) != "agent", F.lit(True))
    numbered = known.withColumn("begins", begins).withColumn("entry_no", F.count_if("begins").over(of_file).cast("int"))
    rule = F.struct(F.col("line").alias("rule_no"), F.col("value").alias("path"), (F.col("name") == RULE_FIELDS[0]).alias("allow"))
    groups = numbered.groupBy("origin", "entry_no").agg(
        F.collect_set(F.when(F.col("kind") == "agent", F.col("value"))).alias("agents"),
        F.count_if(F.col("kind") == "rule").alias("n"),
        F.sort_array(F.collect_list(F.when(F.col("name").isin(RULE_FIELDS), rule))).alias("rules"),
    )
    everything = F.array(F.struct(F.lit(0).alias("rule_no"), F.lit("").alias("path"), F.lit(True).alias("allow")))
    agents = groups.where("n > 0").select("origin", "entry_no", F.explode("agents").alias("agent"), F.when(F.size("rules") > 0, F.col("rules")).otherwise(everything).alias("rules"))
    return agents.select("origin", "entry_no", F.url_decode(_escaped("agent")).alias("agent"), F.inline("rules"))


def chosen_rules(rules: DataFrame, agent: str) -> DataFrame:
    """origin, path (percent-encoded), rule_no, allow: the rules of the one group per origin that applies to ``agent``, the first of each path.

    Rules: origin, entry_no, agent, rule_no, path, allow, as read from the one policy file of the
    origin. The first group naming the agent applies, else the first group for '*'.
    """
    token = agent.split("/")[0].lower()
    named = F.lit(token).contains(F.lower("agent"))
    rows = rules.where((F.col("agent") == "*") | named)
    groups = rows.groupBy("origin", "entry_no").agg(F.bool_or(F.col("agent") == "*").alias("for_all"))
    by_name = F.min(F.when(~F.col("for_all"), F.col("entry_no")))
    picked = groups.groupBy("origin").agg(F.coalesce(by_name, F.min("entry_no")).alias("entry_no"))
    allow = (F.col("allow") | (F.col("path") == "")).alias("allow")
    rows = rows.join(picked, ["origin", "entry_no"]).select("origin", _percent_encoded(F.col("path")).alias("path"), F.struct("rule_no", allow).alias("rule"))
    return rows.groupBy("origin", "path").agg(F.min("rule").alias("rule")).select("origin", "path", "rule.rule_no", "rule.allow")


def _by_prefix(paths: DataFrame, rules: DataFrame) -> DataFrame:
    """origin, _path, allow for the distinct ``paths`` that a rule prefixes: cut at the lengths that the origin's rules have, each cut is looked up."""
    lengths = rules.groupBy("origin").agg(F.collect_set(F.length("path")).alias("lengths"))
    fitting = F.filter("lengths", lambda n: n <= F.length("_path"))
    cut = paths.join(lengths, "origin").select("origin", "_path", F.explode(fitting).alias("n"))
    cut = cut.select("origin", "_path", F.substring(F.col("_path"), F.lit(1), F.col("n")).alias("path"))
    return cut.join(rules, ["origin", "path"]).groupBy("origin", "_path").agg(F.min_by("allow", "rule_no").alias("allow"))


def url_policy(urls: DataFrame, rules: DataFrame, agent: str, enabled: bool = True, few_rules: int = FEW_RULES) -> DataFrame:
    """Add ``allowed``: the first rule in file order that prefixes the path decides, else allowed.

    URLs of origins with up to ``few_rules`` rules meet one row with all of them. Paths of other origins are cut at the lengths of
    the rules' paths and looked up: rows grow with paths times lengths, not with rules. A policy file that
    could not be read is given as rows: none to allow everything, one '/' rule to deny.
    """
    if not enabled:
        return urls.withColumn("allowed", F.lit(True))
    chosen = chosen_rules(rules, agent)
    counts = chosen.groupBy("origin").agg(F.count("*").alias("n"))
    many = materialize(counts.where(F.col("n") > few_rules).select("origin"))
    has_many = not many.isEmpty()
    few = chosen.join(many, "origin", "left_anti") if has_many else chosen
    lists = few.groupBy("origin").agg(F.sort_array(F.collect_list(F.struct("rule_no", "path", "allow"))).alias("rules"))
    placed = urls.withColumn("origin", url_origin("url")).withColumn("_path", policy_path(F.col("url")))
    matching = F.filter("rules", lambda r: F.col("_path").startswith(r["path"]))
    allowed = F.get(matching, F.lit(0))["allow"]
    joined = placed.join(lists, "origin", "left")
    if has_many:
        paths = placed.join(many, "origin", "left_semi").select("origin", "_path").distinct()
        found = _by_prefix(paths, chosen.join(many, "origin", "left_semi")).withColumnRenamed("allow", "_allow")
        joined, allowed = joined.join(found, ["origin", "_path"], "left"), F.coalesce(F.col("_allow"), allowed)
    return joined.withColumn("allowed", F.coalesce(allowed, F.lit(True))).select(*urls.columns, "allowed")


def jitter_ms(url: Column, jitter_seconds: Column) -> Column:
    """A share of the jitter fixed by the URL, so that reruns agree."""
    share = F.conv(F.substring(F.md5(url), 1, 8), 16, 10).cast("bigint")
    return F.floor(F.round(jitter_seconds * 1000) * share / F.lit(2.0**32)).cast("bigint")


def politeness_plan(
    urls: DataFrame,
    delay_seconds: Column | float,
    jitter_seconds: Column | float,
    by: tuple[str, ...] = (),
    rows_per_block: int = HOT_ROWS,
) -> DataFrame:
    """Add ``host, gap_ms, start_ms``: earliest start of each request, per host, in ``seq`` order.

    Consecutive starts on a host are the delay plus a jitter apart; the first request is free. The
    running sum is taken per block of the order and shifted by the totals of earlier blocks, so one
    host may hold any share of the requests. ``by`` adds columns with a pacing of their own.
    """
    delay, jitter = (c if isinstance(c, Column) else F.lit(float(c)) for c in (delay_seconds, jitter_seconds))
    gap = F.round(delay * 1000).cast("bigint") + jitter_ms(F.col("url"), jitter)
    requests = with_blocks(urls.withColumns({"host": url_host("url"), "gap_ms": gap}), "seq", rows_per_block)
    keys = ["host", *by]
    totals = requests.groupBy(*keys, "block").agg(
        F.sum("gap_ms").alias("total"), F.min(F.struct("seq", "gap_ms")).alias("first")
    )
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select(
        *keys,
        "block",
        (F.coalesce(F.sum("total").over(before), F.lit(0)) - F.min("first").over(whole)["gap_ms"]).alias("shift"),
        F.min("first").over(whole)["seq"].alias("first_seq"),
    )
    running = Window.partitionBy(*keys, "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    return (
        requests.withColumn("running", F.sum("gap_ms").over(running))
        .join(shifts, [*keys, "block"])
        .withColumn("gap_ms", F.when(F.col("seq") == F.col("first_seq"), F.lit(0)).otherwise(F.col("gap_ms")))
        .withColumn("start_ms", F.col("running") + F.col("shift"))
        .drop("block", "running", "shift", "first_seq")
    )


def attempt_ends() -> tuple[Column, Column]:
    """Of an attempt (status, error): whether it succeeded, and whether no other should follow."""
    failed = F.coalesce(F.col("error").isNotNull() | (F.col("status") >= FIRST_ERROR_STATUS), F.lit(False))
    retryable = F.coalesce(F.col("error").isin(RETRYABLE_ERRORS), F.lit(False)) | F.coalesce(F.col("status").isin(RETRYABLE_STATUS), F.lit(False))
    return ~failed, ~(failed & retryable)


def fetch_outcomes(log: DataFrame, order: list[str], max_retries: int = 3) -> DataFrame:
    """Per URL of an attempt log (url, status, error): ``fetch, attempts, status``.

    Of the first ``max_retries`` attempts the first success wins and a failure not worth repeating
    ends the series. The rank filter is applied before the shuffle too, so each task sends at most
    ``max_retries`` rows per URL.
    """
    rank = F.row_number().over(Window.partitionBy("url").orderBy(*order))
    tried = log.withColumn("attempt_no", rank).where(F.col("attempt_no") <= max_retries)
    success, ends = attempt_ends()
    attempt = F.struct("attempt_no", success.alias("success"), "status")
    ending = F.min(F.when(ends, attempt))
    last = F.max(attempt)
    settled = tried.groupBy("url").agg(F.coalesce(ending, last).alias("end"))
    return settled.select(
        "url",
        F.when(F.col("end.success"), "ok").otherwise("failed").alias("fetch"),
        F.col("end.attempt_no").alias("attempts"),
        F.col("end.status").alias("status"),
    )
