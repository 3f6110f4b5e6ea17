"""The datasets over one copy of the test tables, built lazily and shared within a query."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlens.functions import stamp_identifiers
from meterlens.operators import consolidate
from meterlens.plans import audit, billing, compute, jobs, metadata, ml_spend, serving, tracking
from meterlens.validation import fixtures


class World:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def feed(self, name: str) -> DataFrame:
        return fixtures.load_feed(self.spark, self.sf_dir, name)

    # source snapshots and histories
    @cached_property
    def usage(self) -> DataFrame:
        return self.feed("usage")

    @cached_property
    def prices(self) -> DataFrame:
        return metadata.list_prices(fixtures.raw_feed(self.spark, self.sf_dir, "list_prices"), fixtures.ACCOUNT)

    @cached_property
    def jobs_current(self) -> DataFrame:
        return jobs.jobs_current(self.feed("jobs"))

    @cached_property
    def clusters_current(self) -> DataFrame:
        return compute.clusters_current(self.feed("clusters"))

    @cached_property
    def served_current(self) -> DataFrame:
        return serving.served_entities_current(self.feed("served_entities"))

    # derived datasets
    @cached_property
    def lines(self) -> DataFrame:
        return billing.billing_summary(self.usage, self.prices)

    @cached_property
    def by_product(self) -> DataFrame:
        return billing.cost_by_product(self.lines)

    @cached_property
    def by_job(self) -> DataFrame:
        return billing.cost_by_job(self.lines)

    @cached_property
    def runs(self) -> DataFrame:
        return jobs.job_runs_summary(self.feed("job_run_timeline"), self.jobs_current)

    @cached_property
    def user_activity(self) -> DataFrame:
        return audit.user_activity_summary(self.feed("audit"))

    @cached_property
    def endpoint_usage(self) -> DataFrame:
        return serving.endpoint_usage_summary(self.feed("endpoint_usage"), self.served_current)

    @cached_property
    def serving_costs(self) -> DataFrame:
        return serving.model_serving_costs(self.lines, self.served_current)

    @cached_property
    def foundation_usage(self) -> DataFrame:
        return serving.foundation_model_usage(self.endpoint_usage)

    @cached_property
    def external_usage(self) -> DataFrame:
        return serving.external_model_usage(self.endpoint_usage)

    @cached_property
    def inventory(self) -> DataFrame:
        return serving.endpoint_inventory(self.served_current, self.serving_costs)

    @cached_property
    def experiments(self) -> DataFrame:
        return tracking.mlflow_experiments_summary(self.feed("experiments_latest"), self.feed("runs_latest"))

    @cached_property
    def ml_runs(self) -> DataFrame:
        return tracking.mlflow_runs_summary(self.feed("runs_latest"))

    @cached_property
    def vector_costs(self) -> DataFrame:
        return ml_spend.vector_search_costs(self.lines)

    @cached_property
    def vector_summary(self) -> DataFrame:
        return ml_spend.vector_search_summary(self.vector_costs)

    @cached_property
    def aiml(self) -> DataFrame:
        return ml_spend.aiml_executive_summary(self.lines)

    # two providers: usage split by account, activity by the parity of the workspace
    def _providers(self, feed: str, is_first) -> dict[str, DataFrame]:
        raw = fixtures.raw_feed(self.spark, self.sf_dir, feed)
        return {
            "account_a": stamp_identifiers(raw.where(is_first), "acct_a", "ws_a"),
            "account_b": stamp_identifiers(raw.where(~is_first), "acct_b", "ws_b"),
        }

    @cached_property
    def provider_lines(self) -> dict[str, DataFrame]:
        usage = self._providers("usage", F.col("account_id") == "0")
        return {name: billing.billing_summary(df, self.prices) for name, df in usage.items()}

    @cached_property
    def all_by_product(self) -> DataFrame:
        return consolidate({name: billing.cost_by_product(df) for name, df in self.provider_lines.items()})

    @cached_property
    def all_aiml(self) -> DataFrame:
        return consolidate({name: ml_spend.aiml_executive_summary(df) for name, df in self.provider_lines.items()})

    @cached_property
    def all_endpoint_usage(self) -> DataFrame:
        requests = self._providers("endpoint_usage", _even_workspace())
        return consolidate(
            {name: serving.endpoint_usage_summary(df, self.served_current) for name, df in requests.items()}
        )

    @cached_property
    def all_job_runs(self) -> DataFrame:
        runs = self._providers("job_run_timeline", _even_workspace())
        return consolidate({name: jobs.job_runs_summary(df, self.jobs_current) for name, df in runs.items()})

    @cached_property
    def all_experiments(self) -> DataFrame:
        experiments = self._providers("experiments_latest", _even_workspace())
        runs = self.feed("runs_latest")
        return consolidate(
            {name: tracking.mlflow_experiments_summary(df, runs) for name, df in experiments.items()}
        )


def _even_workspace():
    return F.col("workspace_id").cast("int") % 2 == 0
