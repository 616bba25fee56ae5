"""Named queries: the reference's analyses as one catalogue of plans.

``Params`` holds every parameter the reference hard-codes (sites, years,
code lists, thresholds). Thresholds, code lists and filters default to the
reference's values; ``TEST`` is the parameter set of the test tables (their
codes, and dates in their 1995-2001 range). ``Context`` builds the shared intermediate tables once per
catalogue, the way the reference's load step builds them once for all
analyses; ``PLANS[name](context)`` returns a DataFrame, and
``QUERIES[name](spark, sf_dir)`` runs a plan on the driver's test tables.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass
from functools import cached_property
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitlens.functions.text import clean_name
from waitlens.operators.predicates import between_dates
from waitlens.operators.reshape import union_all
from waitlens.plans import cube, dims, gap, production, programming, referrals, rejection, routing, snapshots
from waitlens.sources.bucketing import read_bucketed, write_bucketed
from waitlens.sources.catalog import Tables
from waitlens.sources.snapshots import OPEN, publish_snapshot, read_snapshots
from waitlens.sources.testviews import EXIT_REASONS


def _codes(prefix: str) -> tuple[str, ...]:
    return tuple(f"{prefix}{i:06d}" for i in range(1, 26))


_STAGED: dict[tuple[str, str], str] = {}
_PUBLISHED: set[str] = set()
_STAGING_LOCK = threading.RLock()


# Fixed values of the reference: production codes of section A and of section
# A1 (a run of numbers), and the network's production sites.
SECTION_A_CODES: tuple[str, ...] = (
    "07020130", "07020230", "07020330", "07020331", "07020332", "07024219", "07020500", "07020501", "07020600", "07020601",
    "07020700", "07020800", "07020801", "07020900", "07020901", "07021000", "07021001", "07021100", "07021101", "07021230",
    "07021300", "07021301", "07022000", "07022001", "07021531", "07022132", "07022133", "07022134", "07021700", "07021800",
    "07021801", "07021900", "07022130", "07022142", "07022143", "07022144", "07022135", "07022136", "07022137", "07022700",
    "07022800", "07022900", "07021701", "07023100", "07023200", "07023201", "07023202", "07023203", "07023700", "07023701",
    "07023702", "07023703", "07024000", "07024001", "07024200", "07030500", "07024201", "07024202", "07030501", "07030502")
SECTION_A1_CODES: tuple[str, ...] = tuple(f"09600{i}" for i in range(342, 402))
PRODUCTION_SITES: tuple[str, ...] = ("113100", "113130", "113150", "113180", "113181")


@dataclass(frozen=True)
class Params:
    """Parameters of the analyses. Thresholds, code lists and filters have the
    reference's values; sites, years, names and codes of one's own data have
    none and are to be set by whoever runs an analysis that needs them
    (``Given`` names the missing one)."""
    network: str | None = None                     # P1 network of the establishment dimension
    new_visit_service: int = 1                     # service type of new specialist visits (CNE)
    surgery_service: int = 4                       # service type of the waiting-time statistics (P33)
    np_code: str | None = None                     # exit reason: not pertinent
    attended_code: str | None = None               # exit reason: attended
    reasons: dict | None = None                    # exit-reason label -> column; None: from the dimension (A8)
    np_years: tuple[int, ...] | None = None
    np_reference_year: int | None = None
    np_year: int | None = None
    np_min_total: int = 10                         # P10: least exits of a group
    top_k: int = 10                                # P12, P41: diagnoses per specialty
    top_specialties: tuple[str, ...] | None = None
    production_service: int = 13
    section_a_codes: tuple[str, ...] = SECTION_A_CODES
    section_a1_codes: tuple[str, ...] = SECTION_A1_CODES
    production_sites: tuple[str, ...] = PRODUCTION_SITES
    cube_year: int | None = None
    full_gap_year: int | None = None               # B9 option: a year where some specialties only have new demand
    named_sites: tuple[str, ...] | None = None     # abbreviations of the sites with a starting demand
    site: str | None = None                        # hospital of the supply, gap and waiting-time analyses
    communes: tuple[str, ...] | None = None        # cohort communes (P29)
    child_site: str | None = None                  # under-15 lists and routing check (P34, P37)
    child_code: str | None = None
    child_specialty: str | None = None
    routed_to: str | None = None
    routing_from: str | None = None
    list_sites: tuple[str, ...] | None = None      # P6 origin filter
    list_entry: tuple[str, str] | None = None
    union_services: tuple[int, ...] | None = None  # P7; None: all service types
    extract_codes: tuple[str, ...] | None = None   # P36
    extract_communes: tuple[str, ...] | None = None
    export_site: str | None = None                 # P42
    export_exits: tuple[str, str] | None = None
    diagnosis_word: str | None = None              # P13
    word_exit_from: str | None = None
    diagnosis_specialty: str | None = None         # P14
    reason_group_code: str | None = None           # P15
    wait_at: str | None = None                     # P33
    portfolio_network: str | None = None           # P35
    portfolio_target: str | None = None
    portfolio_excluded: str | None = None
    snapshot_dates: tuple[str, ...] | None = None  # S5: dates of the lists' snapshots, two at least
    exits_site: str | None = None                  # P9: destination of a site's own exits
    cohort_buckets: int = 32                       # J5: buckets of the lists and the registry by person


#: Parameters that may stay None.
OPEN_PARAMS = ("reasons", "union_services")


class Given:
    """The parameters, with an error instead of an empty result for one that is not set."""

    def __init__(self, params: Params):
        self._params = params

    def __getattr__(self, name: str):
        value = getattr(self._params, name)
        if value is None and name not in OPEN_PARAMS:
            raise ValueError(f"Params.{name} is not set; this analysis needs it")
        return value


DEFAULT = Params()
# The test tables: own codes, dates in their 1995-2001 range, and groups too
# small for the reference's cuts.
TEST = Params(
    network="South network", np_code="N", attended_code="A",
    reasons={label: clean_name(label) for _, label in EXIT_REASONS}, np_years=(1997, 1998, 1999), np_reference_year=1999,
    np_year=1998, np_min_total=3, top_k=3, top_specialties=tuple(f"Specialty {i:02d}" for i in range(1, 6)),
    section_a_codes=_codes("07"), section_a1_codes=_codes("09"), production_sites=tuple(str(i) for i in range(20)),
    cube_year=1999, full_gap_year=1996, named_sites=tuple(f"S{i}" for i in range(0, 25, 2)), site="3",
    communes=("BUILDING", "MACHINERY"), child_site="7", child_code="07-004", child_specialty="Specialty 04",
    routed_to="13-10", routing_from="1996-04-01", list_sites=tuple(str(i) for i in range(0, 25, 2)),
    list_entry=("1996-01-01", "2000-12-31"), extract_codes=("07-002", "07-003", "07-004"),
    extract_communes=("AMERICA", "ASIA", "EUROPE"), export_site="7", export_exits=("1997-01-01", "1999-12-31"),
    diagnosis_word="ring", word_exit_from="1997-05-08", diagnosis_specialty="Specialty 07", reason_group_code="07-007",
    wait_at="2002-01-01", portfolio_network="Red AMERICA", portfolio_target="7", portfolio_excluded="11",
    snapshot_dates=("1997-01-01", "1998-01-01", "1999-01-01"), exits_site="7", cohort_buckets=8)


class Context:
    """Dimensions and shared facts of one catalogue and parameter set; every
    property is a lazy DataFrame built once per context."""

    # Shared facts every analysis reads: the reference's load step builds
    # them once (enriched lists, combined production, programming). Facts of
    # one wave read those of the waves before it, not each other.
    WAVES = (("le_cne", "exits_cne", "le_open_all", "le_closed_cne", "production", "programming"),
             ("plan_yearly", "demand_monthly", "exits_monthly", "hospital_gap"), ("starting", "cube"))
    SHARED = tuple(name for wave in WAVES for name in wave)
    # folders of the facts that analyses filter by service type or read by year
    FACT_PARTITIONS = {"le_open_all": ("tipo_prest",), "production": ("ano",), "cube": ("ano",)}

    def __init__(self, tables: Tables, params: Params = DEFAULT, folder: str | None = None):
        """``folder`` (shared between driver and executors) takes the tables
        that some analyses publish and read back."""
        self.t = tables
        self.p = Given(params)
        self.folder = folder

    def materialize(self, path: str, names: tuple[str, ...] = SHARED, parallel_jobs: int = 6) -> None:
        """Write the shared facts once as tables under ``path`` (a shared
        folder on a cluster) and read them back, so that every later query
        starts from them instead of rebuilding them, and lineage stops there.
        The facts of a wave are independent jobs, submitted together."""
        import os
        from concurrent.futures import ThreadPoolExecutor

        from waitlens.sources.writers import write_table

        def write(name: str) -> None:
            write_table(getattr(self, name), os.path.join(path, name), partition_by=self.FACT_PARTITIONS.get(name, ()))

        for wave in self.WAVES:
            wave = [name for name in wave if name in names]
            for name in wave:  # built on this thread
                getattr(self, name)
            with ThreadPoolExecutor(max_workers=max(1, parallel_jobs)) as pool:
                for done in [pool.submit(write, name) for name in wave]:
                    done.result()
            for name in wave:
                self.__dict__[name] = self.t.spark.read.parquet(os.path.join(path, name))

    def published(self, name: str, write: Callable[[str], None]) -> str:
        """Folder ``name`` of this context, written by ``write`` once per application."""
        base = self.folder
        if base is None:
            import uuid

            from waitlens.session import ensure_checkpoint_dir
            base = self.folder = f"{ensure_checkpoint_dir(self.t.spark).rstrip('/')}/waitlens-published-{uuid.uuid4().hex[:12]}"
        path = f"{base.rstrip('/')}/{name}"
        with _STAGING_LOCK:
            if path not in _PUBLISHED:
                write(path)
                _PUBLISHED.add(path)
        return path

    # dimensions
    @cached_property
    def estab(self) -> DataFrame:
        return dims.establishments(self.t.establishments_raw, self.t.abbreviations, network=self.p.network)

    @cached_property
    def sites(self) -> DataFrame:
        return dims.establishment_sites(self.t.establishments_raw, network=self.p.network)

    @cached_property
    def abbrev(self) -> DataFrame:
        return dims.abbreviations(self.t.abbreviations)

    @cached_property
    def specs(self) -> DataFrame:
        return dims.specialties(self.t.specialties)

    @cached_property
    def reasons(self) -> DataFrame:
        return dims.exit_reasons(self.t.exit_reasons)

    @cached_property
    def registry(self) -> DataFrame:
        return dims.registry(self.t.registry_raw)

    @property
    def dimargs(self) -> dict:
        return {"estab": self.sites, "specs": self.specs, "abbrev": self.abbrev, "reasons": self.reasons}

    def latest_dates(self, name: str) -> DataFrame:
        return self.t.list_statistics.where(F.col("lista") == name)

    # referral facts
    @cached_property
    def le_cne(self) -> DataFrame:
        """Open list, new specialist visits (the reference's ``fact_le_cne``)."""
        return referrals.enrich_referrals(self.t.open_list, service=self.p.new_visit_service, open_only=True,
                                          statistics=self.latest_dates("open_list"), **self.dimargs)

    @cached_property
    def exits_cne(self) -> DataFrame:
        """Closed list, new specialist visits (``fact_egresos_cne``)."""
        return referrals.enrich_exits(self.t.closed_list, service=self.p.new_visit_service, **self.dimargs)

    # production and programming
    @cached_property
    def production(self) -> DataFrame:
        a = production.section_a(self.t.production_raw, specs=self.specs, service=self.p.production_service,
                                 codes=self.p.section_a_codes, sites=self.p.production_sites)
        a1 = production.section_a1(self.t.production_raw, specs=self.specs, service=self.p.production_service,
                                   codes=self.p.section_a1_codes, sites=self.p.production_sites)
        return production.combined(a, a1)

    @cached_property
    def programming(self) -> DataFrame:
        return self.t.programming.drop("hospital")

    @cached_property
    def plan_yearly(self) -> DataFrame:
        return programming.yearly(self.programming)

    @cached_property
    def demand_monthly(self) -> DataFrame:
        return cube.monthly_demand(self.le_cne)

    @cached_property
    def exits_monthly(self) -> DataFrame:
        return cube.monthly_exits(self.exits_cne, year=self.p.cube_year)

    @cached_property
    def starting(self) -> DataFrame:
        backlog = cube.backlog_before(self.demand_monthly, year=self.p.cube_year, estab=self.estab, specs=self.specs,
                                      abbreviations=self.p.named_sites)
        yearly = cube.yearly_exits(self.exits_monthly, estab=self.estab, specs=self.specs,
                                  abbreviations=self.p.named_sites)
        return cube.starting_demand(backlog, yearly)

    @cached_property
    def cube(self) -> DataFrame:
        in_year = self.production.where(F.col("ano") == self.p.cube_year)  # the reference's file holds one year
        return cube.monthly_cube(in_year, specs=self.specs, demand=self.demand_monthly,
                                 plan_monthly=programming.monthly(self.plan_yearly), abbrev=self.abbrev,
                                 exits=self.exits_monthly)

    @property
    def reason_columns(self):
        """Columns of the exit reasons: as set, or those of the dimension."""
        return self.p.reasons or self.reasons

    @cached_property
    def np_rates(self) -> DataFrame:
        return rejection.np_rate(self.exits_cne, years=self.p.np_years, reasons=self.reason_columns,
                                 min_total=self.p.np_min_total)

    @cached_property
    def rejected_diagnoses(self) -> DataFrame:
        return rejection.rejected_diagnosis_counts(self.exits_cne, np_code=self.p.np_code, year=self.p.np_year,
                                                   specialties=self.p.top_specialties)

    @cached_property
    def top_diagnoses(self) -> DataFrame:
        return rejection.top_rejected_diagnoses(self.rejected_diagnoses, k=self.p.top_k)

    @cached_property
    def supply_summary(self) -> DataFrame:
        return production.summary(self.production, subset=self.t.specialty_subset, site=self.p.site)

    @cached_property
    def supply(self) -> DataFrame:
        return gap.supply_vs_standard(self.supply_summary, yearly_plan=self.plan_yearly,
                                      hours=programming.weekly_hours(self.programming), specs=self.specs,
                                      subset=self.t.specialty_subset, yield_table=self.t.yield_table, site=self.p.site)

    @cached_property
    def cohort(self) -> DataFrame:
        return gap.enrolled_cohort(self.exits_cne, self.le_cne, self.registry, communes=self.p.communes,
                                   subset=self.t.specialty_subset)

    @cached_property
    def le_open_all(self) -> DataFrame:
        """Open list, every service type, enriched (the reference loads it as
        its open-list fact)."""
        return referrals.enrich_referrals(self.t.open_list, statistics=self.latest_dates("open_list"), **self.dimargs)

    @cached_property
    def le_closed_cne(self) -> DataFrame:
        """Closed list of new specialist visits, enriched with the V1 columns
        (the reference's closed-list fact)."""
        return referrals.enrich_referrals(self.t.closed_list, service=self.p.new_visit_service,
                                          statistics=self.latest_dates("closed_list"), **self.dimargs)

    @property
    def gap_parts(self) -> tuple[DataFrame, DataFrame]:
        return self.le_open_all, self.le_closed_cne

    @cached_property
    def hospital_gap(self) -> DataFrame:
        return gap.hospital_gap(*self.gap_parts, self.production, year=self.p.cube_year, site=self.p.site,
                                specs=self.specs)


def _v2_open(c: Context, site: str | None = None) -> DataFrame:
    """V2 on the open list, read from the open list enriched for all services."""
    return referrals.v2_from_enriched(c.le_open_all, site=site or c.p.site, service=c.p.new_visit_service)


def _np_ids(c: Context) -> DataFrame:
    ex = c.exits_cne.where((F.col("c_salida") == c.p.np_code)
                           & between_dates("f_salida", f"{c.p.np_year}-01-01", f"{c.p.np_year + 1}-01-01"))
    return ex.select(F.concat(F.col("run"), F.col("dv")).alias("id"))


PLANS: dict[str, Callable[[Context], DataFrame]] = {
    # dimensions, sources
    "establishments": (lambda c: c.estab),
    "registry_clean": (lambda c: c.registry),
    "inline_dim": (lambda c: _inline_dim(c)),
    # referral enrichment
    "referrals_enriched": (lambda c: referrals.refiltered(
        c.le_open_all, service=c.p.new_visit_service, sites=list(c.p.list_sites), entry_from=c.p.list_entry[0],
        entry_to=c.p.list_entry[1])),
    "open_closed_union": (lambda c: referrals.open_closed_union(
        c.t.open_list, c.t.closed_list, service=c.p.union_services and list(c.p.union_services),
        statistics=c.t.list_statistics, **c.dimargs)),
    "referrals_v2": (lambda c: _v2_open(c)),
    "exits_enriched": (lambda c: c.exits_cne),
    "specialty_extract": (lambda c: referrals.specialty_extract(
        c.le_cne, codes=c.p.extract_codes, communes=c.p.extract_communes)),
    "under15_open": (lambda c: referrals.under_age_list(_v2_open(c, c.p.child_site), code=c.p.child_code)),
    "under15_closed": (lambda c: referrals.under_age_list(referrals.v2_from_enriched(
        c.le_closed_cne, site=c.p.child_site, service=c.p.new_visit_service), code=c.p.child_code)),
    "exits_export": (lambda c: referrals.refiltered(
        c.le_closed_cne, service=c.p.new_visit_service, sites=[c.p.export_site], exit_from=c.p.export_exits[0],
        exit_to=c.p.export_exits[1])),
    "exits_of_site": (lambda c: referrals.enrich_exits(
        c.t.closed_list, service=c.p.new_visit_service, sites=[c.p.exits_site], **c.dimargs)),
    # rejection analyses
    "np_rate": (lambda c: rejection.np_rate(c.exits_cne, years=(c.p.np_year,), reasons=c.reason_columns,
                                              min_total=c.p.np_min_total)),
    "np_rate_all_years": (lambda c: c.np_rates),
    "np_rate_from_dimension": (lambda c: rejection.np_rate(
        # without the last reason of the dimension its exits have none: the na column
        _exits_with(c, c.reasons.where(F.col("causal") != _last_reason(c))), years=c.p.np_years,
        reasons=c.reasons.where(F.col("causal") != _last_reason(c)), min_total=c.p.np_min_total, na_column="na")),
    "np_rate_ordered": (lambda c: rejection.np_rate_ordered(c.np_rates, reference_year=c.p.np_reference_year)),
    "top_diagnoses": (lambda c: c.top_diagnoses),
    "ranked_diagnoses": (lambda c: rejection.ranked_diagnoses(c.rejected_diagnoses, k=c.p.top_k)),
    "age_bands": (lambda c: rejection.rejected_by_age_band(c.exits_cne, word=c.p.diagnosis_word, np_code=c.p.np_code,
                                                             exit_from=c.p.word_exit_from)),
    "rejected_by_diagnosis": (lambda c: rejection.rejected_by_diagnosis(
        c.exits_cne, specialty=c.p.diagnosis_specialty, np_code=c.p.np_code, year=c.p.np_year)),
    "exits_by_reason_group": (lambda c: rejection.exits_by_reason_group(
        c.exits_cne, code=c.p.reason_group_code, attended_code=c.p.attended_code, np_code=c.p.np_code,
        year=c.p.np_year)),
    "yearly_totals_long": (lambda c: rejection.yearly_totals_long(c.np_rates)),
    "np_share_mean": (lambda c: rejection.np_share_mean(c.np_rates)),
    # programming
    "programming_union": (lambda c: c.programming),
    "programming_yearly": (lambda c: c.plan_yearly),
    "programming_hours": (lambda c: programming.weekly_hours(c.programming)),
    "programming_monthly": (lambda c: programming.monthly(c.plan_yearly)),
    "programming_by_activity": (lambda c: programming.by_activity(c.plan_yearly, c.t.programmed_activities)),
    # production
    "production_section_a": (lambda c: production.section_a(
        c.t.production_raw, specs=c.specs, service=c.p.production_service, codes=c.p.section_a_codes,
        sites=c.p.production_sites)),
    "production_section_a1": (lambda c: production.section_a1(
        c.t.production_raw, specs=c.specs, service=c.p.production_service, codes=c.p.section_a1_codes,
        sites=c.p.production_sites)),
    "production_sections_null_safe": (lambda c: c.production),
    "production_grain_report": (lambda c: production.grain_report(c.production)),
    "production_summary": (lambda c: c.supply_summary),
    # cube
    "monthly_demand": (lambda c: c.demand_monthly),
    "monthly_exits": (lambda c: c.exits_monthly),
    "yearly_exits_named_sites": (lambda c: cube.yearly_exits(c.exits_monthly, estab=c.estab, specs=c.specs,
                                                               abbreviations=c.p.named_sites)),
    "backlog_before_year": (lambda c: cube.backlog_before(c.demand_monthly, year=c.p.cube_year, estab=c.estab,
                                                            specs=c.specs, abbreviations=c.p.named_sites)),
    "starting_demand": (lambda c: c.starting),
    "monthly_cube": (lambda c: c.cube),
    "running_backlog": (lambda c: cube.running_backlog(
        c.cube, cube.backlog_start(c.demand_monthly, c.abbrev, year=c.p.cube_year),
        start_keys=["abreviacion", "codigosigte"], start_value="n")),
    "dashboard_backlog": (lambda c: cube.running_backlog(
        c.cube, c.starting, start_keys=["abreviacion", "desc_esp"], start_value="demanda_acumulada")),
    "choices_sites": (lambda c: cube.choices(c.starting, "abreviacion")),
    "choices_specialties": (lambda c: cube.choices(c.starting, "desc_esp")),
    "dashboard_from_published": (lambda c: _dashboard_from_published(c)),
    "choices_from_published": (lambda c: _choices_from_published(c)),
    # snapshots of the lists
    "snapshot_backlog": (lambda c: snapshots.backlog_by_date(
        read_snapshots(c.t.spark, _snapshots(c), dates=c.p.snapshot_dates[1:], state=OPEN), service=c.p.new_visit_service)),
    "snapshot_flow": (lambda c: snapshots.flow(
        read_snapshots(c.t.spark, _snapshots(c), state=OPEN), before=c.p.snapshot_dates[0], after=c.p.snapshot_dates[-1],
        service=c.p.new_visit_service)),
    # supply and gap
    "supply_vs_standard": (lambda c: c.supply),
    "supply_mean_ratio": (lambda c: gap.mean_ratio(c.supply)),
    "enrolled_cohort": (lambda c: c.cohort),
    "enrolled_cohort_bucketed": (lambda c: _bucketed_cohort(c)),
    "cohort_gap": (lambda c: gap.cohort_gap(c.cohort, c.production, year=c.p.cube_year, site=c.p.site,
                                              subset=c.t.specialty_subset)),
    "hospital_gap": (lambda c: c.hospital_gap),
    "hospital_gap_full": (lambda c: gap.hospital_gap(*c.gap_parts, c.production, year=c.p.full_gap_year,
                                                       site=c.p.site,
                                                       specs=c.specs, how="full")),
    "still_waiting_at": (lambda c: gap.still_waiting(*c.gap_parts, at=f"{c.p.cube_year}-01-01")),
    "gap_current": (lambda c: gap.gap_current(c.hospital_gap)),
    "gap_new_projected": (lambda c: gap.gap_new_projected(c.hospital_gap, c.t.projection)),
    "gap_projected": (lambda c: gap.gap_projected(c.hospital_gap, c.t.projection)),
    "gap_total_new_visits": (lambda c: gap.total_new_visits(c.hospital_gap)),
    "wait_mean_median": (lambda c: gap.waiting_time_stats(c.t.sigte, service=c.p.surgery_service, site=c.p.site,
                                                            at=c.p.wait_at)),
    "wait_mean_median_datetimes": (lambda c: gap.waiting_time_stats(
        c.t.sigte_datetimes, service=c.p.surgery_service, site=c.p.site, at=c.p.wait_at)),
    # routing
    "misrouted_by_pattern": (lambda c: routing.misrouted(_v2_open(c, c.p.child_site), c.t.referral_map,
                                                           specialty=c.p.child_specialty, destination=c.p.routed_to,
                                                           entry_from=c.p.routing_from)),
    "misrouted_by_regex": (lambda c: routing.misrouted(_v2_open(c, c.p.child_site), c.t.referral_map,
                                                         specialty=c.p.child_specialty, destination=c.p.routed_to,
                                                         entry_from=c.p.routing_from, codes_as_patterns=True)),
    "portfolio_crosstab": (lambda c: routing.portfolio_crosstab(
        # only site, level and diagnosis columns are counted: the enriched open list serves as it is
        c.le_open_all.where(F.col("tipo_prest") == c.p.new_visit_service),
        network_sites=c.t.network_sites, network=c.p.portfolio_network, portfolio=c.t.portfolio,
        target_site=c.p.portfolio_target, excluded_site=c.p.portfolio_excluded)),
    "diagnosis_split": (lambda c: routing.diagnosis_split(c.le_cne)),
    "registry_lookup": (lambda c: routing.registry_lookup(c.registry, _np_ids(c), "id")),
}


def _last_reason(c: Context) -> str:
    return list(c.p.reasons or rejection.pivot_values(c.reasons, "causal"))[-1]


def _exits_with(c: Context, reasons: DataFrame) -> DataFrame:
    return referrals.enrich_exits(c.t.closed_list, service=c.p.new_visit_service, **{**c.dimargs, "reasons": reasons})


def _snapshots(c: Context) -> str:
    """The open lists as they were at the snapshot dates, one snapshot per date; the first is published
    twice, the second time in place of the first."""
    def write(path: str) -> None:
        for date in (c.p.snapshot_dates[0], *c.p.snapshot_dates):
            publish_snapshot(snapshots.open_at(c.t.open_list, c.t.closed_list, at=date), path, date=date, state=OPEN)

    return c.published("snapshots", write)


def _results(c: Context) -> str:
    return c.published("cube", lambda path: cube.publish_results(cube_df=c.cube, starting=c.starting, production=c.production, path=path))


def _dashboard_from_published(c: Context) -> DataFrame:
    """The dashboard's backlog from the cube's published version."""
    months, starting, _ = cube.read_results(c.t.spark, _results(c))
    return cube.running_backlog(months, starting, start_keys=["abreviacion", "desc_esp"], start_value="demanda_acumulada")


def _choices_from_published(c: Context) -> DataFrame:
    """What the dashboard offers, from the published starting demand."""
    _, starting, _ = cube.read_results(c.t.spark, _results(c))
    parts = [cube.choices(starting, name).select(F.lit(name).alias("columna"), F.col(name).alias("valor")) for name in ("abreviacion", "desc_esp")]
    return union_all(parts)


def _bucketed_cohort(c: Context) -> DataFrame:
    """P29 from lists and registry bucketed by person: no shuffle at the join."""
    import hashlib

    def registered(path: str) -> str:
        return f"waitlens_bucketed_{hashlib.sha1(path.encode()).hexdigest()[:16]}"

    def table(name: str, rows: Callable[[], DataFrame], key: str) -> DataFrame:
        path = c.published(f"bucketed_{name}", lambda place: write_bucketed(
            rows(), registered(place), place, key=key, buckets=c.p.cohort_buckets))
        return read_bucketed(c.t.spark, registered(path))

    return gap.enrolled_cohort(table("exits", lambda: c.exits_cne, "run"), table("waiting", lambda: c.le_cne, "run"),
                               table("registry", lambda: c.registry, "rut_paciente_sdv"), communes=c.p.communes, subset=c.t.specialty_subset)


def _inline_dim(c: Context) -> DataFrame:
    """S3: the literal service-type table joined to referral counts per type."""
    counts = c.t.open_list.groupBy("tipo_prest").agg(F.count(F.lit(1)).alias("n"))
    st = c.t.service_types.withColumnRenamed("n", "tipo_prest_id")
    return counts.join(st, counts.tipo_prest == st.tipo_prest_id, "left").drop("tipo_prest_id")


def _staging(spark: SparkSession, sf_dir: str) -> str:
    """Folder of one application and scale factor under the session's
    checkpoint folder (a shared folder on a cluster) for the test-table joins:
    each is written once, by the first query that reads it, and not joined
    again."""
    import hashlib
    import os

    from waitlens.session import ensure_checkpoint_dir
    key = (spark.conf.get("spark.app.id", None) or str(id(spark)), os.path.abspath(sf_dir))
    with _STAGING_LOCK:
        if key not in _STAGED:
            base = ensure_checkpoint_dir(spark).rstrip("/")
            _STAGED[key] = f"{base}/waitlens-views-{hashlib.sha1('|'.join(key).encode()).hexdigest()[:12]}"
        return _STAGED[key]


def _driver_query(fn: Callable[[Context], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = _staging(spark, sf_dir)
        return fn(Context(Tables.from_driver(spark, sf_dir, folder=folder), TEST, f"{folder}/published"))
    run.__doc__ = fn.__doc__
    return run


# Each query on the driver's test tables: (spark, sf_dir) -> DataFrame.
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: _driver_query(v) for k, v in PLANS.items()}
