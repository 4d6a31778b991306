"""Growth analytics on Spark: metrics, features, models and reports for a shop-plus-subscription business.

Every operator is a plain function from DataFrames to a DataFrame.  Nothing here reads the clock: whatever
depends on "today" takes an explicit ``as_of`` date.
"""

from larkspur.session import build_session
from larkspur.sources.tables import Tables

__all__ = ["Tables", "build_session"]
