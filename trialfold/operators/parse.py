"""Log -> metric rows.

Input lines carry the wanted metric list per row (``metrics`` array, first
element = objective), usually attached by a size-checked broadcast join of
the experiment table.  Output rows: (trial, seq, sub, ts_raw, ts, ts_nanos,
metric, value), the long form of the reference's observation log.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialfold.functions.exprs import DEFAULT_FILTER, UNAVAILABLE, ZERO_TIME, rfc3339_parts, small

OBS_COLUMNS = ["trial", "seq", "sub", "ts_raw", "ts", "ts_nanos", "metric", "value"]

_BRACE = re.compile(r"(?<!\\)\{(?!\d+(,\d*)?\})")


def re2_to_java(pattern: str) -> str:
    """RE2 takes a literal '{' that does not open a repetition; Java needs
    it escaped.  RE2 has no look-around or back-references, so nothing else
    needs rewriting."""
    return _BRACE.sub(r"\\{", pattern)


def group_count(pattern: str) -> int:
    try:
        return re.compile(pattern).groups
    except re.error:
        return -1


def keyword_prefilter(lines: DataFrame, line_col: str = "line", metrics_col: str = "metrics") -> DataFrame:
    """Keep a line only if it contains any wanted metric name."""
    return lines.filter(F.exists(F.col(metrics_col), lambda m: F.col(line_col).contains(m)))


def leading_timestamp(line: Column) -> tuple[Column, Column, Column]:
    """First space-delimited token when it is RFC3339Nano.
    Returns (ts_raw, ts, ts_nanos); ts_raw is the Go zero time otherwise."""
    has_sep = F.instr(line, " ") > 0
    tok = F.when(has_sep, F.substring_index(line, " ", 1))
    ts, nanos = rfc3339_parts(tok)
    ok = ts.isNotNull()
    return F.when(ok, tok).otherwise(F.lit(ZERO_TIME)), F.when(ok, ts), F.when(ok, nanos)


def extract_pairs(line: Column, filters: list[str] | None) -> Column:
    """O14/O15 as one array column: array<struct<name,value>> of all
    matches of all filters, in filter order then match order, both groups
    trimmed (``parse_text_lines`` uses the exploded form instead)."""
    pats = [re2_to_java(p) for p in (filters or [DEFAULT_FILTER]) if group_count(p) >= 2]
    parts = []
    for p in pats:
        names = F.regexp_extract_all(line, F.lit(p), 1)
        values = F.regexp_extract_all(line, F.lit(p), 2)
        parts.append(F.transform(F.arrays_zip(names.alias("n"), values.alias("v")),
                                 lambda z: F.struct(F.trim(z["n"]).alias("name"), F.trim(z["v"]).alias("value"))))
    if not parts:
        return F.array().cast("array<struct<name:string,value:string>>")
    return parts[0] if len(parts) == 1 else F.flatten(F.array(*parts))


def parse_text_lines(lines: DataFrame, filters: list[str] | None = None,
                     line_col: str = "line", metrics_col: str = "metrics") -> DataFrame:
    """O12–O16 over a table (trial, line_no, line, metrics).  Each filter's
    matches are exploded (``regexp_extract_all`` group 0) and the two groups
    re-read from the matched text, which keeps the stage free of
    interpreted higher-order functions; ``sub`` orders filters, then
    matches."""
    l = keyword_prefilter(lines, line_col, metrics_col)
    ts_raw, ts, nanos = leading_timestamp(F.col(line_col))
    pats = [re2_to_java(p) for p in (filters or [DEFAULT_FILTER]) if group_count(p) >= 2]
    base = l.select("trial", F.col("line_no").alias("seq"), F.col(metrics_col).alias("metrics"),
                    ts_raw.alias("ts_raw"), ts.alias("ts"), nanos.alias("ts_nanos"), F.col(line_col).alias("line"))
    parts = []
    for i, p in enumerate(pats):
        x = base.select("trial", "seq", "metrics", "ts_raw", "ts", "ts_nanos",
                        F.posexplode(F.regexp_extract_all(F.col("line"), F.lit(p), 0)).alias("pos", "m"))
        x = x.select("trial", "seq", "metrics", "ts_raw", "ts", "ts_nanos",
                     (F.lit(i << 32) + F.col("pos")).cast("long").alias("sub"),
                     F.trim(F.regexp_extract("m", p, 1)).alias("metric"), F.trim(F.regexp_extract("m", p, 2)).alias("value"))
        parts.append(x)
    if not parts:
        return base.select("trial", "seq", F.lit(0).cast("long").alias("sub"), "ts_raw", "ts", "ts_nanos",
                           F.lit(None).cast("string").alias("metric"), F.lit(None).cast("string").alias("value")).filter(F.lit(False))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    # O16 whitelist: name must be one of the wanted metrics
    out = out.filter(F.array_contains("metrics", F.col("metric")))
    return out.select(*OBS_COLUMNS)


# What the reference's engine has and the JVM's hasn't, and the other way.
#: Names of its bracket classes, as the JVM calls them.
POSIX_CLASSES = {"alnum": "Alnum", "alpha": "Alpha", "ascii": "ASCII", "blank": "Blank", "cntrl": "Cntrl", "digit": "Digit", "graph": "Graph",
                 "lower": "Lower", "print": "Print", "punct": "Punct", "space": "Space", "upper": "Upper", "xdigit": "XDigit"}
#: Look-around, atomic groups, back references, possessive repetition and ungreedy mode: the JVM takes them, the other engine doesn't.
FOREIGN = r"\(\?(?:[=!>]|<[=!]|P=|P>|[a-z]*U)|\\[1-9k]|[*+?]\+|\{\d+(?:,\d*)?\}\+"


def java_pattern(p: Column) -> Column:
    """An RE2 pattern for the JVM engine: group names go (groups are read by
    number), bracket classes and scripts get their names there, a brace that
    opens no repetition is escaped.  NULL for what RE2 itself doesn't take."""
    out = F.regexp_replace(p, r"(?<!\\)\{(?!\d+(,\d*)?\})(?<!\\[pPx]\{)", r"\\{")
    out = F.regexp_replace(out, r"\(\?P?<(?![=!])\w+>", "(")
    out = F.regexp_replace(out, r"(\\[pP]\{)([A-Z][a-z]{2,}\w*)\}", "$1Is$2}")
    for name, java in POSIX_CLASSES.items():
        out = F.regexp_replace(F.regexp_replace(out, rf"\[:{name}:\]", rf"\\p{{{java}}}"), rf"\[:\^{name}:\]", rf"\\P{{{java}}}")
    return F.when(~p.rlike(FOREIGN), out)


def filter_verdicts(filters: DataFrame, pattern: str = "pattern") -> DataFrame:
    """``filters`` with ``java`` (the pattern for the JVM engine, NULL if it can't
    be used) and ``error``.  The JVM itself compiles each pattern, and one that
    it refuses is an error of its own row, never of the job."""
    p = F.col(pattern)
    bare = F.regexp_replace(F.regexp_replace(p, r"\\.", ""), r"\[(?:\[:\^?\w+:\]|[^\]])*\]", "")
    groups = F.regexp_count(bare, F.lit(r"\((?!\?)|\(\?P?<(?![=!])"))
    java = java_pattern(p)
    compiles = F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("compile"), java).isNotNull()
    error = (F.when(p.isNull() | java.isNull() | ~compiles, F.lit("filter does not compile"))
             .when(groups < 2, F.lit("filter must have at least two capture groups")))
    return filters.withColumn("error", error).withColumn("java", F.when(F.col("error").isNull(), java))


def usable_filters(filters: DataFrame) -> DataFrame:
    """(experiment, pos, pattern) as the JVM engine takes them.  The pattern is
    NULL where the filter doesn't compile or has less than two groups: it
    finds nothing (``filter_verdicts`` names it)."""
    return filter_verdicts(filters).select("experiment", "pos", F.col("java").alias("pattern"))


def parse_by_filters(lines: DataFrame, filters: DataFrame, line_col: str = "line", metrics_col: str = "metrics") -> DataFrame:
    """O12–O16 with each experiment's own filters: ``filters`` is a table
    (experiment, pos, pattern), ``lines`` carries ``experiment``.  An experiment
    without a row there has the default filter; ``sub`` orders filters, then
    matches.  Groups are read where they match, so anchors keep their sense."""
    l = keyword_prefilter(lines, line_col, metrics_col)
    ts_raw, ts, nanos = leading_timestamp(F.col(line_col))
    head = ["seq", "metrics", "ts_raw", "ts", "ts_nanos"]
    base = l.select("experiment", "trial", F.col("line_no").alias("seq"), F.col(metrics_col).alias("metrics"),
                    ts_raw.alias("ts_raw"), ts.alias("ts"), nanos.alias("ts_nanos"), F.col(line_col).alias("line"))
    j = base.join(small(usable_filters(filters)), "experiment", "left")
    p = F.when(F.col("pos").isNull(), F.lit(re2_to_java(DEFAULT_FILTER))).otherwise(F.col("pattern"))
    j = j.withColumn("pattern", p).filter(F.col("pattern").isNotNull())
    found = F.arrays_zip(F.regexp_extract_all("line", "pattern", F.lit(1)).alias("n"),
                         F.regexp_extract_all("line", "pattern", F.lit(2)).alias("v"))
    x = j.select("trial", *head, F.coalesce("pos", F.lit(0)).cast("long").alias("filter_pos"), F.posexplode(found).alias("at", "m"))
    return (x.select("trial", *head, (F.shiftleft("filter_pos", 32) + F.col("at")).alias("sub"),
                     F.trim(F.col("m")["n"]).alias("metric"), F.trim(F.col("m")["v"]).alias("value"))
            .filter(F.array_contains("metrics", F.col("metric"))).select(*OBS_COLUMNS))


def objective_fallback(rows: DataFrame, trial_list: DataFrame) -> DataFrame:
    """Trials whose log has no objective row get their whole log
    replaced by one (zero time, objective, 'unavailable') row.

    ``trial_list``: (trial, objective).  Skew-safe: the objective test is a
    partially aggregated distinct, not a window over a trial's rows.
    """
    obj = small(trial_list.select("trial", "objective"))
    with_obj = (rows.join(obj, "trial").filter(F.col("metric") == F.col("objective"))
                    .select("trial").distinct())
    kept = rows.join(with_obj, "trial", "left_semi")
    fallback = (trial_list.join(with_obj, "trial", "left_anti")
                .select("trial", F.lit(0).cast("long").alias("seq"), F.lit(0).cast("long").alias("sub"),
                        F.lit(ZERO_TIME).alias("ts_raw"), F.lit(None).cast("timestamp").alias("ts"),
                        F.lit(None).cast("int").alias("ts_nanos"),
                        F.col("objective").alias("metric"), F.lit(UNAVAILABLE).alias("value")))
    return kept.select(*OBS_COLUMNS).unionByName(fallback)


def attach_metric_lists(lines: DataFrame, experiments: DataFrame) -> DataFrame:
    """Per-line metric list (objective first, then additional metrics) from
    the experiment table; the experiment side is broadcast behind a size
    check."""
    m = experiments.select("experiment", F.concat(F.array("objective_metric"), F.col("additional_metrics")).alias("metrics"))
    return lines.join(small(m), "experiment")


def parse_json_lines(lines: DataFrame, mode: str = "failfast", accept_numbers: bool = False,
                     metrics_col: str = "metrics", line_col: str = "line") -> DataFrame:
    """JSON-lines logs.  Empty lines skipped.  A metric counts
    only when its JSON value is a string (Q2) unless ``accept_numbers``.
    ``mode='failfast'`` raises on a malformed line; ``'permissive'`` drops it
    (see ``json_rejects``); ``'drop_file'`` drops every line of a trial that
    has a malformed one."""
    l = lines.filter(F.length(line_col) > 0)
    if mode == "drop_file":
        # one corrupt line voids its whole log (as the reference's collector
        # fails the file): drop every row of the affected trials
        l = l.join(json_rejects(lines, line_col).select("trial").distinct(), "trial", "left_anti")
    v = F.parse_json(line_col) if mode == "failfast" else F.try_parse_json(line_col)
    l = l.select("trial", F.col("line_no").alias("seq"), F.col(metrics_col).alias("metrics"), v.alias("v"))
    l = l.filter(F.col("v").isNotNull())
    l = l.select("trial", "seq", "metrics", F.col("v").try_cast("map<string,variant>").alias("m"))
    l = add_json_time(l, F.element_at(F.col("m"), F.lit("timestamp")))
    x = l.select("trial", "seq", "m", "ts_raw", "ts", "ts_nanos", F.posexplode("metrics").alias("sub", "metric"))
    val = F.element_at(F.col("m"), F.col("metric"))
    kind = F.schema_of_variant(val)
    ok = kind == "STRING"
    if accept_numbers:
        ok = ok | kind.startswith("BIGINT") | kind.startswith("DECIMAL") | kind.startswith("DOUBLE")
    x = x.filter(F.col("m").isNotNull() & ok)
    return x.select("trial", "seq", F.col("sub").cast("long").alias("sub"), "ts_raw", "ts", "ts_nanos", "metric",
                    val.cast("string").alias("value"))


def json_rejects(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Lines that are not valid JSON (the permissive side table)."""
    return lines.filter((F.length(line_col) > 0) & F.try_parse_json(line_col).isNull())


def add_json_time(df: DataFrame, tsv: Column, compat: str = "literal") -> DataFrame:
    """Adds ts_raw, ts, ts_nanos from the JSON timestamp value: a string
    must be RFC3339Nano; a number's decimal text is split at '.', its fraction
    digits read as nanoseconds as written (Q1, ``compat='literal'``) or as a
    true decimal fraction (``'decimal'``).  In stages, so that each
    intermediate is computed once per row and not in every branch."""
    d = df.withColumn("_tv", tsv)
    d = d.withColumn("_tk", F.schema_of_variant("_tv")).withColumn("_ts", F.col("_tv").cast("string"))
    s, kind = F.col("_ts"), F.col("_tk")
    str_ts, str_nanos = rfc3339_parts(s)
    d = d.withColumn("_st", str_ts).withColumn("_sn", str_nanos)
    is_num = kind.startswith("BIGINT") | kind.startswith("DECIMAL") | kind.startswith("DOUBLE")
    txt = F.when(F.lower(s).contains("e"), s.cast("decimal(38,9)").cast("string")).otherwise(s)
    parts = F.split(txt, r"\.")
    d = d.withColumn("_sec", F.when(is_num, parts.getItem(0).try_cast("long"))).withColumn(
        "_frac", F.when(is_num, F.regexp_replace(F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")), "0+$", "")))
    frac = F.col("_frac")
    if compat == "literal":
        fn = F.when(frac == "", F.lit(0)).otherwise(frac.try_cast("long"))
    else:
        fn = F.when(frac == "", F.lit(0)).otherwise(F.rpad(F.substring(frac, 1, 9), 9, "0").cast("long"))
    d = d.withColumn("_tot", F.col("_sec") * 1000000000 + fn)
    d = d.withColumn("_nts", F.timestamp_micros(F.floor(F.col("_tot").cast("decimal(38,0)") / F.lit(1000)).cast("long"))) \
         .withColumn("_nn", F.pmod(F.col("_tot"), F.lit(1000000000)).cast("int"))
    ok_str = (kind == "STRING") & F.col("_st").isNotNull()
    ok_num = is_num & F.col("_sec").isNotNull()
    nn = F.col("_nn")
    raw = F.when(ok_str, s).when(ok_num, F.concat(F.date_format("_nts", "yyyy-MM-dd'T'HH:mm:ss"),
                                                    F.when(nn > 0, F.concat(F.lit("."), F.regexp_replace(F.lpad(nn.cast("string"), 9, "0"), "0+$", ""))).otherwise(F.lit("")),
                                                    F.lit("Z"))).otherwise(F.lit(ZERO_TIME))
    d = d.withColumn("ts_raw", raw).withColumn("ts", F.when(ok_str, F.col("_st")).when(ok_num, F.col("_nts"))).withColumn(
        "ts_nanos", F.when(ok_str, F.col("_sn")).when(ok_num, nn))
    return d.drop("_tv", "_tk", "_ts", "_st", "_sn", "_sec", "_frac", "_tot", "_nts", "_nn")


def filter_pattern_check(specs: DataFrame, pattern_col: str = "filter") -> DataFrame:
    """A collector filter must compile and hold at least two
    parenthesised groups.  Output: (…, valid, reason).  The engine that
    reads the logs compiles it (``filter_verdicts``)."""
    two = F.col(pattern_col).rlike(r".*\(.*\).*\(.*\).*")
    compiles = F.col("error").isNull() | (F.col("error") != "filter does not compile")
    return (filter_verdicts(specs, pattern_col).withColumn("valid", two & compiles)
            .withColumn("reason", F.when(~compiles, F.lit("filter does not compile"))
                        .when(~two, F.lit("filter must have at least two capture groups"))).drop("error", "java"))
