"""Run metrics from an event log (company, kind, component, message, value, ts)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from debenture.functions import patterns as P
from debenture.working import saved, working


def counters(log: DataFrame) -> DataFrame:
    n = lambda kind: F.count_if(F.col("kind") == kind)
    return log.agg(
        n("end").alias("companies_processed"),
        F.coalesce(F.sum(F.when(F.col("kind") == "found", F.col("value"))), F.lit(0)).cast("long").alias("documents_found"),
        n("download").alias("documents_downloaded"),
        n("cache").alias("documents_from_cache"),
        n("bot").alias("bot_detections"),
    )


def success_rates(log: DataFrame) -> DataFrame:
    """(company, found, processed, rate, report_rate): rate is null where nothing was found, report_rate counts it as one."""
    g = log.groupBy("company").agg(
        F.coalesce(F.sum(F.when(F.col("kind") == "found", F.col("value"))), F.lit(0)).cast("long").alias("found"),
        F.count_if(F.col("kind").isin("download", "cache")).alias("processed"),
    )
    return g.withColumns({"rate": F.when(F.col("found") > 0, F.col("processed") / F.col("found")), "report_rate": F.col("processed") / F.greatest(F.col("found"), F.lit(1))})


def errors(log: DataFrame, strict: bool = False) -> DataFrame:
    """The log's errors; those of components beyond the known three don't count (strict: they do)."""
    e = log.filter("kind = 'error'")
    return e if strict else e.filter(F.col("component").isin(P.ERROR_COMPONENTS))


def error_rollup(log: DataFrame, strict: bool = False) -> DataFrame:
    """(component, n): per component, and in all under `total`."""
    g = errors(log, strict).rollup("component").agg(F.count("*").alias("n"), F.grouping("component").alias("g"))
    return g.select(F.when(F.col("g") == 1, "total").otherwise(F.col("component")).alias("component"), "n")


def error_top(log: DataFrame, n: int = 5, order: str = "seq", strict: bool = False) -> DataFrame:
    """The first n errors of each component, with their rank, and how many more there are. Spark cuts each task's rows to n a component
    before they are moved (WindowGroupLimit), so what comes together for one is n times the tasks at most."""
    e = errors(log, strict)
    rank = F.row_number().over(Window.partitionBy("component").orderBy(order))
    more = e.groupBy("component").agg((F.greatest(F.count("*"), F.lit(n)) - n).alias("more"))
    return e.withColumn("rank", rank).filter(F.col("rank") <= n).join(more, "component").select("component", "rank", "message", "more")


def renewals(requests: DataFrame, seconds: int, most: int) -> DataFrame:
    """requests(company, seq, at) with n, the request's number among its company's in the order of at and seq (from 0), and next, the
    number of the request that would begin the next session if a session began here: the first one more than `seconds` later, or
    the one `most` requests on, whichever is earlier; null where there is none.

    Requests are dealt out by company and stretch of time, `seconds` + 1 long, so a company may be in many tasks; what is gathered by
    company is a count per stretch. How many requests lie within `seconds` of one is read from a mark in its own or the next stretch."""
    stretch = lambda c: F.floor(c / (seconds + 1))
    d = requests.withColumn("stretch", stretch(F.col("at")))
    counts = d.groupBy("company", "stretch").agg(F.count("*").alias("many"))
    before = Window.partitionBy("company").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    every = counts.select("company", F.explode(F.array("stretch", F.col("stretch") + 1)).alias("stretch")).distinct().join(counts, ["company", "stretch"], "left")
    every = every.withColumn("before", F.coalesce(F.sum("many").over(before), F.lit(0))).select("company", "stretch", "before")
    # a request, and its mark `seconds` later, which stands behind all requests of that time
    both = d.select("company", "seq", "at", F.explode(F.array(F.lit(0), F.lit(1))).alias("mark")).withColumn("when", F.col("at") + F.col("mark") * seconds)
    both = both.withColumn("stretch", stretch(F.col("when"))).join(every, ["company", "stretch"])
    order = Window.partitionBy("company", "stretch").orderBy("when", "mark", "seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # requests up to here, this one not counted
    upto = F.col("before") + F.count_if(F.col("mark") == 0).over(order)
    both = both.withColumn("upto", upto)
    starts = both.filter("mark = 0").select("company", "seq", "at", (F.col("upto") - 1).alias("n"))
    within = both.filter("mark = 1").select("company", "seq", F.col("at").alias("began"), F.col("upto").alias("later"))
    total = counts.groupBy("company").agg(F.sum("many").alias("total"))
    out = starts.join(within.drop("began"), ["company", "seq"]).join(total, "company")
    return out.select("company", "seq", "at", "n", F.least(F.col("later"), F.col("n") + most).alias("next"), "total").withColumn("next", F.when(F.col("next") < F.col("total"), F.col("next"))).drop("total")


def session_marks(log: DataFrame, seconds: int = 3600, requests: int = 100) -> DataFrame:
    """(company, seq, session, request, age_s, renew): before each request the session is looked at; if it is older than `seconds`
    or has had `requests` requests, it is renewed, and its clock and its count begin anew. session counts from 0, request
    within the session; age_s is the session's age after that look. Requests of a company are in the order of ts and seq; seq tells the
    rows of a company apart. Rows without company are a company's, rows without ts don't take part.

    Each request points to the one that would be renewed next; which of them begin a session follows from the first by doubling: known
    beginnings reach others by pointers over 1, 2, 4, ... sessions, so the rounds are the logarithm of a company's sessions."""
    spark = log.sparkSession
    # a null company gets a name that no other one has
    name = F.coalesce(F.concat(F.lit("1"), F.col("company").cast("string")), F.lit("0"))
    d = log.select(name.alias("company"), "seq", F.unix_timestamp("ts").alias("at")).filter("at is not null")
    with working(spark) as keep:
        rows = keep(saved(renewals(d, seconds, requests), "session-rows"))
        jump = saved(rows.filter("next is not null").select("company", "n", "next"), "session-jumps")
        begun = saved(rows.filter("n = 0").select("company", "n", F.lit(0).cast("long").alias("session")), "session-begun")
        step = 1
        while not jump.isEmpty():
            reached = begun.join(jump, ["company", "n"]).select("company", F.col("next").alias("n"), (F.col("session") + step).alias("session"))
            begun, step = saved(begun.unionByName(reached), "session-begun"), 2 * step
            far = jump.select("company", F.col("n").alias("first"), F.col("next").alias("n")).join(jump, ["company", "n"]).select("company", F.col("first").alias("n"), "next")
            jump = saved(far, "session-jumps")
        begun = keep(begun)
    # a session's requests are those from its beginning to the next one's
    begin = begun.join(rows.select("company", "n", "at", "next"), ["company", "n"]).select(F.col("company").alias("of"), F.col("n").alias("first"), "session", F.col("at").alias("began"), F.col("next").alias("last"))
    part = lambda c: F.floor(c / requests)
    held = begin.withColumn("last", F.coalesce("last", F.col("first") + requests)).withColumn("part", F.explode(F.sequence(part(F.col("first")), part(F.col("last") - 1))))
    out = rows.withColumn("at_part", part(F.col("n"))).join(held, (F.col("company") == F.col("of")) & (F.col("at_part") == F.col("part")) & (F.col("n") >= F.col("first")) & (F.col("n") < F.col("last")))
    name = F.when(F.startswith("company", F.lit("1")), F.expr("substring(company, 2)"))
    return out.select(name.alias("company"), "seq", "session", (F.col("n") - F.col("first")).alias("request"), (F.col("at") - F.col("began")).alias("age_s"), ((F.col("n") == F.col("first")) & (F.col("n") > 0)).alias("renew"))


def batch_totals(log: DataFrame) -> DataFrame:
    """(company, processed, errors, seconds): documents downloaded or read from the cache, errors, and the time from the first to
    the last event."""
    seconds = F.unix_timestamp(F.max("ts")) - F.unix_timestamp(F.min("ts"))
    return log.groupBy("company").agg(F.count_if(F.col("kind").isin("download", "cache")).alias("processed"), F.count_if(F.col("kind") == "error").alias("errors"), seconds.alias("seconds"))


def report(log: DataFrame) -> DataFrame:
    """(part, of, line), the text report, in the order of part and of: companies by name with their figures, then errors by component."""
    rates = success_rates(log).join(batch_totals(log).select("company", "seconds"), "company")
    company = rates.select(F.lit(1).alias("part"), "company", F.concat(F.lit("  - "), "company", F.lit(": runtime "), F.col("seconds").cast("string"), F.lit(" s, found "), F.col("found").cast("string"), F.lit(", processed "), F.col("processed").cast("string"), F.lit(", success rate "), F.format_number(100 * F.col("report_rate"), 2), F.lit("%")).alias("line"))
    error = error_rollup(log).select(F.when(F.col("component") == "total", 2).otherwise(3).alias("part"), F.col("component").alias("company"), F.when(F.col("component") == "total", F.concat(F.lit("Total errors: "), F.col("n").cast("string"))).otherwise(F.concat(F.lit("  - "), "component", F.lit(": "), F.col("n").cast("string"), F.lit(" errors"))).alias("line"))
    return company.unionByName(error).select("part", F.col("company").alias("of"), "line")


def save_metrics(log: DataFrame, path: str) -> None:
    """counters, success_rates, batch_totals, errors as JSON, and the report as text, below path."""
    for name, part in (("counters", counters(log)), ("success_rates", success_rates(log)), ("batch_totals", batch_totals(log)), ("errors", error_top(log))):
        part.write.mode("overwrite").json(f"{path}/{name}")
    report(log).orderBy("part", "of").select("line").coalesce(1).write.mode("overwrite").text(f"{path}/report")


def retry_delay(attempt: Column, base: float = 5.0) -> Column:
    """The fixed part of the wait before attempt k (from 0); up to half of base comes on top at random."""
    return F.lit(base) * F.pow(F.lit(2.0), attempt)
