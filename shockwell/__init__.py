"""Market-risk stresses of an insurer's investments as Spark DataFrames."""

from shockwell.parameters import CalculationMatrix, Parameters, ReportingPeriod

__all__ = ["CalculationMatrix", "Parameters", "ReportingPeriod"]
