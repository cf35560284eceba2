"""Run parameters: regulatory numbers, calculation matrix, reporting period.

All of this is configuration of a fixed size.  It is read once on the driver
and enters the plans as literals, so no module reads a file or joins a
parameter table for it.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from shockwell import fixed_values as fv


@dataclass(frozen=True)
class Parameters:
    """Regulatory parameters; the defaults are the published values."""

    strategic_shock: float = fv.STRATEGIC_SHOCK
    t1_base_shock: float = fv.T1_BASE_SHOCK
    t2_base_shock: float = fv.T2_BASE_SHOCK
    currency_up_shock: float = fv.CURRENCY_UP_SHOCK
    currency_down_shock: float = fv.CURRENCY_DOWN_SHOCK
    property_shock: float = fv.PROPERTY_SHOCK
    rated_a: list = field(default_factory=lambda: fv.BOND_RATED_A)
    rated_b: list = field(default_factory=lambda: fv.BOND_RATED_B)
    unrated_a: list = field(default_factory=lambda: fv.BOND_UNRATED_A)
    unrated_b: list = field(default_factory=lambda: fv.BOND_UNRATED_B)
    thresholds: list = field(default_factory=lambda: fv.EXCESS_EXPOSURE_THRESHOLDS)
    risk_factors: list = field(default_factory=lambda: fv.RISK_FACTORS)
    gov_risk_factors: list = field(default_factory=lambda: fv.GOV_RISK_FACTORS)
    tolerance: float = fv.CONCENTRATION_TOLERANCE
    type_rows: Mapping[str, int] = field(default_factory=lambda: fv.CALCULATION_TYPE_ROWS)
    oecd_countries: list = field(
        default_factory=lambda: fv.EEA_COUNTRIES + fv.OECD_NON_EEA_COUNTRIES
    )
    country_currency: Mapping[str, str] = field(default_factory=lambda: fv.COUNTRY_CURRENCY)

    @classmethod
    def from_dict(cls, doc: Mapping) -> Parameters:
        spread, conc = doc["spread_risk_matrices"], doc["concentration_risk"]
        return cls(
            strategic_shock=doc["equity_risk"]["strategic_shock"],
            t1_base_shock=doc["equity_risk"]["T1_base_shock"],
            t2_base_shock=doc["equity_risk"]["T2_base_shock"],
            currency_up_shock=doc["currency_risk"]["currency_up_shock"],
            currency_down_shock=doc["currency_risk"]["currency_down_shock"],
            property_shock=doc["property_risk"]["property_shock"],
            rated_a=spread["bond_rated_a_i_matrix"],
            rated_b=spread["bond_rated_b_i_matrix"],
            unrated_a=spread["bond_unrated_a_i_matrix"],
            unrated_b=spread["bond_unrated_b_i_matrix"],
            thresholds=conc["excess_exposure_thresholds"],
            risk_factors=conc["risk_factors"],
            gov_risk_factors=conc["other_gov_bonds_risk_factors"],
            tolerance=conc["tolerance"],
            type_rows=doc["calculation_type_mapping"],
            oecd_countries=doc["EEA_COUNTRIES"] + doc["OECD_NON_EEA_COUNTRIES"],
            country_currency=doc["COUNTRY_CURRENCY_MAPPING"],
        )

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Parameters:
        """Read the parameter JSON from any path Spark can reach."""
        text = spark.read.text(path, wholetext=True).first()[0]
        return cls.from_dict(json.loads(text))

    def curve_prefixes(self) -> list[tuple[str, str]]:
        """``(currency, curve code prefix)``: the euro has its own curve, any
        other currency takes the first country listed for it."""
        first: dict[str, str] = {fv.EURO: fv.EURO}
        for country, currency in self.country_currency.items():
            first.setdefault(currency, country)
        return list(first.items())


@dataclass(frozen=True)
class CalculationMatrix:
    """Which calculation types each stress module applies to."""

    flags: Mapping[str, frozenset]

    @classmethod
    def from_rows(
        cls,
        rows: Iterable[Mapping[str, str]],
        type_rows: Mapping[str, int],
        flag_columns: Mapping[str, str] = fv.MODULE_FLAG_COLUMN,
    ) -> CalculationMatrix:
        """``rows`` in workbook order; a type owns the row of its number and
        belongs to a module when that module's column holds ``x``."""
        table = list(rows)
        return cls({
            module: frozenset(t for t, row in type_rows.items() if table[row][column] == "x")
            for module, column in flag_columns.items()
        })

    @classmethod
    def read(
        cls,
        spark: SparkSession,
        path: str,
        params: Parameters,
        currency_flag_column: str = fv.MODULE_FLAG_COLUMN["currency"],
    ) -> CalculationMatrix:
        """Read the matrix from a CSV with the module columns as header.

        The file has one line per calculation type, so its text is fixed in
        size; reading it whole keeps the line order that gives rows their meaning.
        """
        import csv
        import io

        text = spark.read.text(path, wholetext=True).first()[0]
        columns = {**fv.MODULE_FLAG_COLUMN, "currency": currency_flag_column}
        return cls.from_rows(csv.DictReader(io.StringIO(text)), params.type_rows, columns)

    def table(self, spark: SparkSession) -> DataFrame:
        """``(module, calculation_type)``, the modules' own types included."""
        rows = [(m, t) for m in self.flags for t in self.types_for(m)]
        return spark.createDataFrame(rows, "module string, calculation_type string")

    def types_for(self, module: str) -> list[str]:
        return sorted(self.flags[module] | set(fv.MODULE_EXTRA_TYPES[module]))


@dataclass(frozen=True)
class ReportingPeriod:
    year: int
    month: int

    def __post_init__(self):
        if self.month not in fv.QUARTER_MONTHS:
            raise ValueError(f"reporting month must be one of {fv.QUARTER_MONTHS}: {self.month}")
