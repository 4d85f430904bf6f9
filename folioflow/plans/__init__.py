"""The catalogue of queries: QUERIES and, where SQL can say it, ORACLE_SQL."""

from . import books, drafts, masks, records, reviews  # noqa: F401
from .catalogue import ORACLE_SQL, QUERIES  # noqa: F401
