"""Imports every module that registers gate queries."""

from tripmart.plans import gate  # noqa: F401
from tripmart.plans import gate_reports  # noqa: F401
from tripmart.plans import gate_models  # noqa: F401
from tripmart.plans import gate_sinks  # noqa: F401
from tripmart.plans import gate_sources  # noqa: F401
from tripmart.plans import gate_layered  # noqa: F401
from tripmart.plans import gate_quality  # noqa: F401
from tripmart.plans import gate_streaming  # noqa: F401
from tripmart.plans import gate_similarity  # noqa: F401
from tripmart.plans import gate_loads  # noqa: F401
