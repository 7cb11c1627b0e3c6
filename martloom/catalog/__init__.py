"""All registered queries; importing the modules fills the registry."""

from . import (  # noqa: F401
    join_queries,
    load_queries,
    rule_queries,
    source_queries,
    star_queries,
    study_queries,
    moment_queries,
)
from .registry import REGISTRY  # noqa: F401
