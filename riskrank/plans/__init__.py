"""End-to-end flows: fit on one split, score another, rank and report."""

from riskrank.plans.scoring import RankingReport, RiskModel, fit_risk_model, fit_score_rank, ranking_report

__all__ = ["RankingReport", "RiskModel", "fit_risk_model", "fit_score_rank", "ranking_report"]
