"""Column functions: null semantics, text, numbers and dates."""

from florametrics.functions.nulls import *  # noqa: F401,F403
from florametrics.functions.numbers import *  # noqa: F401,F403
from florametrics.functions.text import *  # noqa: F401,F403
