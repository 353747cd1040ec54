"""Query catalog: importing this package registers every query module."""

from panelcast.plans import registry  # noqa: F401
from panelcast.plans import q_panel  # noqa: F401
from panelcast.plans import q_events  # noqa: F401
from panelcast.plans import q_analytics  # noqa: F401
from panelcast.plans import q_serving  # noqa: F401
from panelcast.plans import q_misc  # noqa: F401
from panelcast.plans import q_text  # noqa: F401
from panelcast.plans import q_lemma  # noqa: F401
from panelcast.plans import q_ml  # noqa: F401
from panelcast.plans import q_stream  # noqa: F401
from panelcast.plans import q_models  # noqa: F401
from panelcast.plans import q_forecast  # noqa: F401
from panelcast.plans import q_future  # noqa: F401
from panelcast.plans import q_io  # noqa: F401

QUERIES = registry.QUERIES
ORACLES = registry.ORACLES
