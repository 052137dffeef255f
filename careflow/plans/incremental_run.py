"""The warehouse kept up to date from what is new.

``run`` takes the staged rows that are newer than the high-water marks of the
last commit, and rewrites only the buckets that they touch:

* prescriptions and diagnoses lie in buckets of their patient.  A thin table in
  buckets of the id says which patient an id had, so a row that comes again
  under another patient is taken out of the old one's bucket;
* the patients of changed rows, old and new, are the touched patients: journeys
  and switches are computed anew for them and for nobody else;
* patients are versions with dates (T8), spliced by the day of arrival.

All tables and the new marks become visible by one commit.  Running over parts
of the input, one after the other, gives what one run over all of it gives, also
where a run dies between two writes and is started again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import incremental, kpi_state, warehouse
from ..session import DEALT_ROWS, dealt_buckets, drop_checkpoint, keyed_checkpoint, reliable_checkpoint
from ..sources.buckets import BucketStore, Commit

#: id, the columns of a diagnosis that the journey needs
DIAGNOSIS_COLUMNS = ["diagnosis_id", "patient_id", "icd_code", "diagnosis_date", "severity"]
#: What a source's rows are told apart by.
KEYS = {"prescriptions": "prescription_id", "diagnoses": "diagnosis_id", "patients": "patient_id"}
#: Keys above which a table is dealt out by them before it meets them; fewer are broadcast.
MANY_KEYS = DEALT_ROWS
PATIENT_ATTRIBUTES = ["gender", "date_of_birth", "region", "enrollment_date"]


def _changed_facts(commit: Commit, name: str, index: str, key: str, ids: DataFrame, rows: DataFrame, dealt: int) -> DataFrame:
    """Upsert rows that lie in buckets of their patient; returns the touched patients.
    ``ids``: all ids that came, also those whose row is dropped by cleaning.  Only ids
    that the index knows have a row to take out, so the table meets those alone.
    ``dealt``: the buckets by ``key`` that ``ids`` lie in."""
    places = rows.select(key, "patient_id")
    before, many = places.limit(0), 0
    if commit.has(index):
        before = keyed_checkpoint(commit.rows_of_keys(index, ids, key, dealt=dealt), key, dealt)
        many = dealt if dealt > 1 and before.count() > MANY_KEYS else 0
    commit.upsert(name, rows, key, keys=before, by="patient_id", also=places, placed=True, dealt=many)
    commit.upsert(index, places, key, keys=before, also=places, placed=True, dealt=many)
    return before.select(*places.columns).unionByName(places).select("patient_id").distinct()


def run(store: BucketStore, sources: dict[str, DataFrame], column: str = "ingested_at", keep: int = 2,
        kpis: bool = False) -> dict:
    """One load of all that is new.  ``sources``: staged ``prescriptions``,
    ``diagnoses``, ``patients`` (any of them), append-only, stamped by ``column``;
    rows stamped like the mark or before are taken as loaded, rows without a stamp
    are left.  ``kpis``: the state of the KPIs (``operators/kpi_state.py``) is kept too;
    the first run with it builds it from the whole tables.  Returns the number
    of new rows of each source, the touched buckets of each table, and the commit."""
    unknown = set(sources) - {"prescriptions", "diagnoses", "patients"}
    if unknown:
        raise ValueError(f"no source is called {sorted(unknown)}")
    commit = store.begin()
    new = {name: incremental.delta_rows(rows.filter(F.col(column).isNotNull()), commit.marks.get(name), column)
           for name, rows in sources.items()}
    dealt = {name: dealt_buckets(store.spark, rows.count()) for name, rows in new.items()}
    fresh = {name: keyed_checkpoint(rows, KEYS[name], dealt[name]) for name, rows in new.items()}
    counts = {name: rows.count() for name, rows in fresh.items()}
    before = {name: dict(entry["parts"]) for name, entry in commit.tables.items()}
    touched: list[DataFrame] = []
    rx_touched = None
    if counts.get("prescriptions"):
        facts = reliable_checkpoint(warehouse.transform_prescriptions(fresh["prescriptions"], placed=dealt["prescriptions"] > 1))
        rx_touched = _changed_facts(commit, "fact_prescription", "prescription_patient", "prescription_id",
                                    fresh["prescriptions"].select("prescription_id"), facts, dealt["prescriptions"])
        touched.append(rx_touched)
    if counts.get("diagnoses"):
        last = warehouse.dedup_keep_last(fresh["diagnoses"], "diagnosis_id", placed=dealt["diagnoses"] > 1)
        last = reliable_checkpoint(last.select(*DIAGNOSIS_COLUMNS))
        touched.append(_changed_facts(commit, "diagnosis", "diagnosis_patient", "diagnosis_id",
                                      fresh["diagnoses"].select("diagnosis_id"), last, dealt["diagnoses"]))
    if touched:
        patients = touched[0]
        for more in touched[1:]:
            patients = patients.unionByName(more)
        _journeys(commit, reliable_checkpoint(patients.distinct()),
                  None if rx_touched is None else reliable_checkpoint(rx_touched))
    if counts.get("patients"):
        _patients(commit, fresh["patients"], column)
    if kpis:
        moved = [] if rx_touched is None else [rx_touched]
        if counts.get("patients"):
            moved.append(fresh["patients"].select("patient_id").distinct())
        _kpis(commit, moved)
    for name, rows in fresh.items():
        commit.marks[name] = incremental.mark_text(rows, column) or commit.marks.get(name)
    number = commit.publish()
    for rows in fresh.values():
        drop_checkpoint(rows)
    store.vacuum(keep)
    return {"rows": counts, "commit": number,
            "touched": {name: sum(entry["parts"].get(b) != t for b, t in before.get(name, {}).items())
                        for name, entry in commit.tables.items()}}


def _journeys(commit: Commit, patients: DataFrame, rx_patients: DataFrame | None) -> None:
    """T5 and T6 of the touched patients."""
    tables = ["fact_prescription", "diagnosis", "fact_patient_journey", "therapy_switches"]
    if rx_patients is not None and commit.same_buckets(tables, "patient_id") and _most_patients(commit, patients):
        _journeys_of_buckets(commit, commit.touched("fact_prescription", patients, "patient_id"))
        return

    def of(name: str) -> DataFrame | None:
        return commit.rows_of_keys(name, patients, "patient_id") if commit.has(name) else None

    facts, diagnoses = of("fact_prescription"), of("diagnosis")
    if facts is None:    # no prescription has come yet
        facts = diagnoses.limit(0).select(
            F.lit("").alias("prescription_id"), "patient_id", F.lit("").alias("drug_name"),
            F.col("diagnosis_date").cast("date").alias("prescription_date"), F.lit("").alias("therapy_area"))
    if rx_patients is None:
        journeys = warehouse.build_patient_journey(facts, diagnoses)
    else:
        journeys, switches = warehouse.journeys_and_switches(facts, diagnoses)
        commit.upsert("therapy_switches", switches, "patient_id", keys=patients, placed=True)
    commit.upsert("fact_patient_journey", journeys, "patient_id", keys=patients, placed=True)


def _most_patients(commit: Commit, patients: DataFrame) -> bool:
    """Whether the touched patients are too many to be broadcast and an eighth of all or more."""
    many = patients.count()
    if many <= MANY_KEYS:
        return False
    return many * 8 >= commit.read("fact_prescription").agg(F.approx_count_distinct("patient_id")).first()[0]


def _journeys_of_buckets(commit: Commit, buckets: list[int]) -> None:
    """T5 and T6 of all patients of the touched buckets.  Where most patients are touched
    this takes less than meeting four tables with them: the buckets are written anew
    anyhow, and no row of the old journeys and switches has to be found and kept."""
    facts = commit.read("fact_prescription", buckets)
    diagnoses = commit.read("diagnosis", buckets) if commit.has("diagnosis") else None
    rows = facts.count() + (0 if diagnoses is None else diagnoses.count())
    journeys, switches = warehouse.journeys_and_switches(facts, diagnoses, buckets=dealt_buckets(commit.store.spark, rows))
    for name, made in [("therapy_switches", switches), ("fact_patient_journey", journeys)]:
        commit.write(name, made.limit(0), "patient_id", buckets, placed=made)


def _patients(commit: Commit, arrived: DataFrame, column: str) -> None:
    """The versions that arrived, spliced into the history of their keys."""
    days = arrived.withColumn("changed_on", F.col(column).cast("date"))
    last = warehouse.keep_last(days, ["patient_id", "changed_on"], [column])
    clean = warehouse.normalize_dates(last, ["date_of_birth", "enrollment_date"])
    changes = reliable_checkpoint(clean.select("patient_id", *PATIENT_ATTRIBUTES, "changed_on"))
    name = "dim_patient"
    if commit.has(name):
        history = commit.rows_of_keys(name, changes, "patient_id")
    else:
        history = None
    spliced = incremental.scd2_splice(history, changes, "patient_id", PATIENT_ATTRIBUTES)
    commit.upsert(name, spliced, "patient_id", keys=changes)


def _kpis(commit: Commit, moved: list[DataFrame]) -> None:
    """What the load changes, computed for the touched patients from the
    tables as they were and as they are; one new part of each state table."""
    tables = ["fact_prescription", "therapy_switches", "dim_patient"]
    first = not commit.has("kpi_counts")
    if not all(map(commit.has, tables)) or not (moved or first):
        return      # no KPI before all three tables exist
    rows = commit.read("fact_prescription").select(F.count(F.lit(1))).first()[0]
    dealt = dealt_buckets(commit.store.spark, rows)
    who, many = None, dealt
    if not first:
        patients = moved[0]
        for more in moved[1:]:
            patients = patients.unionByName(more)
        who = reliable_checkpoint(patients.distinct())
        if dealt > 1 and who.count() > MANY_KEYS:
            who = keyed_checkpoint(who, "patient_id", dealt)
        else:
            many = 0

    def of(name: str, base: bool = False) -> DataFrame:
        columns = kpi_state.COLUMNS[name]
        if who is None:
            return keyed_checkpoint(commit.read(name).select(*columns), "patient_id", dealt) if many > 1 else commit.read(name)
        return commit.rows_of_keys(name, who, "patient_id", base, columns, many)

    after = kpi_state.contributions(*(of(name) for name in tables))
    before = after.limit(0) if first else kpi_state.contributions(*(of(name, True) for name in tables))
    changed = reliable_checkpoint(kpi_state.change(before, after))
    commit.append("kpi_counts", kpi_state.count_changes(changed), kpi_state.merged_counts)
    commit.append("kpi_physicians", kpi_state.physician_changes(changed), kpi_state.physician_changes)
    toggles = keyed_checkpoint(kpi_state.toggled(changed), "patient_id", dealt)
    numbers = "patient_number"
    slices = commit.touched(numbers, toggles, "patient_id")
    known = commit.read(numbers, slices) if commit.has(numbers) else toggles.limit(0).select(
        "patient_id", F.lit(0).alias("slice"), F.lit(0).cast("long").alias("position"))
    fresh = reliable_checkpoint(kpi_state.new_numbers(toggles, known, commit.slice_of(numbers, F.col("patient_id"))))
    commit.append("kpi_members", kpi_state.member_changes(toggles, known.unionByName(fresh)), kpi_state.merged_members)
    commit.upsert(numbers, fresh, "patient_id")
    for table in (changed, toggles, fresh, who):
        if table is not None:
            drop_checkpoint(table)
