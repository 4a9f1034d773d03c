from .medallion import bronze_query, gold_query, silver_query
from .scoring import ChampionLoader, scoring_query

__all__ = ["bronze_query", "gold_query", "silver_query", "ChampionLoader", "scoring_query"]
