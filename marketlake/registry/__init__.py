"""All registered queries; importing this package fills the registry."""

from marketlake.registry import boards, feeds, patterns, relational, streams, windows  # noqa: F401
from marketlake.registry.core import ORACLES, QUERIES  # noqa: F401
