"""Shop analytics on Spark: sessions, hot categories, page flows, area products, ad clicks."""

from clickloom.params import TaskParams
from clickloom.session import build_session

__all__ = ["TaskParams", "build_session"]
