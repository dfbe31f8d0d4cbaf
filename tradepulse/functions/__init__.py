"""Scalar expressions, all built from JVM-side Spark functions."""

from tradepulse.functions.scalars import *  # noqa: F401,F403
from tradepulse.functions.text import keywords, tokens  # noqa: F401
