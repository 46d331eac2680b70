"""The operators bound to a set of general test tables.

``views`` shapes the tables as game data and feed documents; ``core``,
``documents``, ``stored`` and ``archived`` hold one query per operator with the SQL that must
give the same rows.
"""

from rinkframe.bindings import archived, core, documents, stored  # noqa: F401
from rinkframe.bindings.registry import QUERIES  # noqa: F401
