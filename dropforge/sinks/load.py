"""The load run: choose drops, check headers, conform, save with history, report what could not be used."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dropforge.functions.calendar import reference_date
from dropforge.operators.profile_state import Profile, keep_state
from dropforge.plans.registry import Views
from dropforge.quality.drops import header_report, issues, require_valid
from dropforge.quality.expectations import Expectation, violation_columns, violation_counts
from dropforge.sinks.publish import require_loaded
from dropforge.sinks.store import Commit, Store
from dropforge.sources.headers import Header, read_headers
from dropforge.sources.landing import select_drops
from dropforge.sources.reader import MALFORMED, conform, fault_counts, good_rows, malformed_rows, read_text
from dropforge.sources.schemas import SOURCES, Source

REJECTED = "_rejected"
FAULTS = "table_name string, fault string, column_name string, found long"


def load_drop(
    run: Commit, path: str, source: Source, day: date, header: Header | None = None, suite: list[Expectation] | None = None, *, beside: bool = False
) -> tuple[dict[str, int], list[int]]:
    """Conform one drop into its table and history as part of a run.

    Gives the counts of ``fault_counts`` and the violations of ``suite``, all taken on the way: the drop is parsed once and
    the loaded rows are not read again. Rows of another width than the header go to the history of ``<table>_rejected``, as
    they are in the drop; only a drop that has such rows is parsed for them again. ``beside`` adds to what the day has.
    """
    raw = read_text(run.store.spark, path, source, header)
    counts = fault_counts(raw, source)
    seen, checked = Observation(), Observation()
    rows = conform(good_rows(raw.observe(seen, *[c.alias(f"n{i}") for i, c in enumerate(counts.values())])), source)
    if suite:
        rows = rows.observe(checked, *[c.alias(f"v{i}") for i, c in enumerate(violation_columns(rows, suite))])
    run.load(rows, source.name, day, beside=beside)
    found = {name: seen.get[f"n{i}"] or 0 for i, name in enumerate(counts)}
    violated = [checked.get[f"v{i}"] for i in range(len(suite))] if suite else []
    rejected = source.name + REJECTED
    if found["malformed"] or (run.store.has_history(rejected) and not beside):
        malformed = malformed_rows(raw).select(F.lit(path).alias("drop"), F.col(MALFORMED).alias("row"))
        run.append_history(malformed, rejected, day, beside=beside)
    return found, violated


def load_all(
    spark: SparkSession,
    landing: str,
    store: Store,
    *,
    today: str | date | None = None,
    sources: dict[str, Source] | None = None,
    check_headers: bool = True,
    on_invalid: str = "stop",
    most_malformed: float | None = None,
    suites: dict[str, list[Expectation]] | None = None,
    profiles: dict[str, Profile] | None = None,
    at_once: int = 4,
) -> tuple[Views, DataFrame, DataFrame]:
    """Load the newest drop of every source; gives the views over the store, the row counts and the faults.

    All loads are published together at the end (``Store.commit``): a run that stops for any reason changes nothing,
    and the views stand on the version that it published. All declared tables are there after it, empty where no drop came.
    ``on_invalid="skip"`` loads the other drops when one has another header than declared. ``most_malformed`` stops the run
    if a larger share of a drop's rows was rejected. ``suites`` are expectations to count violations of, by table, as the
    rows are written. ``profiles`` are input profiles to keep the state of, by table (``profile_of_history``). ``at_once`` drops are loaded side by side, so that small ones do not leave the cluster waiting.

    Faults are rows ``table_name, fault, column_name, found``: ``malformed`` rows, ``failed_cast``,
    ``unmapped_boolean``, ``cut_text``, ``header`` (with the issue for a column) and violated expectations.
    """
    if on_invalid not in ("stop", "skip"):
        raise ValueError("on_invalid is 'stop' or 'skip'")
    sources = sources or SOURCES
    day = reference_date(today)
    drops = select_drops(spark, landing, sources)
    if not drops:
        raise FileNotFoundError(f"no drop of a declared source under {landing}")
    by_path = {path: sources[name] for name, path in drops.items()}
    headers = read_headers(spark, by_path, at_once)
    faults = []
    if check_headers:
        report = header_report(spark, by_path, headers)
        if on_invalid == "stop":
            require_valid(report)
        else:
            wrong = [(r["file"], r["issue"]) for r in issues(report).collect()]  # a few rows per drop at most
            faults += [(by_path[f].name, "header", issue, 1) for f, issue in wrong]
            drops = {name: path for name, path in drops.items() if path not in {f for f, _ in wrong}}

    suites = suites or {}
    with store.commit() as run:

        def load(drop):
            name, path = drop
            found = load_drop(run, path, sources[name], day, headers[path], suites.get(sources[name].name))
            if name in (profiles or {}):
                keep_state(run, name, day, profiles[name])
            return found

        def declare(source):
            if source.fields is not None and source.name not in drops:
                run.declare(source)

        with ThreadPoolExecutor(at_once) as pool:
            list(pool.map(declare, sources.values()))
            loaded = dict(zip(drops, pool.map(load, drops.items()), strict=True))
        found = {name: counts for name, (counts, _) in loaded.items()}
        counts = spark.createDataFrame([(name, n["rows"]) for name, n in found.items()], "table_name string, row_count long")
        require_loaded(counts)
        if most_malformed is not None:
            over = [n for n, c in found.items() if c["malformed"] > most_malformed * (c["rows"] + c["malformed"])]
            if over:
                raise RuntimeError(f"too many malformed rows: {', '.join(sorted(over))}")
    for name, n in found.items():
        for key, many in n.items():
            if many and key != "rows":
                faults.append((name, *(key.split(":", 1) if ":" in key else (key, "")), many))
    for name, (_, violated) in loaded.items():
        faults += [(name, f"expectation:{e.kind}", e.column, v) for e, v in zip(suites.get(name) or (), violated, strict=True) if v]
    unseen = [t for t in suites if t not in loaded]  # tables without a drop in this run
    for table in unseen:
        if store.has(table):
            held = violation_counts(store.read(table), suites[table]).where("violations > 0").collect()  # one row per expectation
            faults += [(table, f"expectation:{r.expectation}", r.column_name, r.violations) for r in held]
    return Views(store.snapshot(), day), counts, spark.createDataFrame(faults, FAULTS)


def run(spark: SparkSession, landing: str, store: Store, **options) -> tuple[Views, DataFrame]:
    """``load_all`` without the faults."""
    return load_all(spark, landing, store, **options)[:2]
