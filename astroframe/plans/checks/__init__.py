"""Checked queries, one module per operator family (imported for registration)."""

from astroframe.plans.checks import etl  # noqa: F401
from astroframe.plans.checks import clean  # noqa: F401
from astroframe.plans.checks import features  # noqa: F401
from astroframe.plans.checks import classify  # noqa: F401
from astroframe.plans.checks import aggregate  # noqa: F401
from astroframe.plans.checks import windows  # noqa: F401
from astroframe.plans.checks import joins_orbits  # noqa: F401
from astroframe.plans.checks import reshape  # noqa: F401
from astroframe.plans.checks import functions  # noqa: F401
from astroframe.plans.checks import sources  # noqa: F401
from astroframe.plans.checks import ml_exact  # noqa: F401
from astroframe.plans.checks import ml_models  # noqa: F401
from astroframe.plans.checks import streaming  # noqa: F401
from astroframe.plans.checks import runs  # noqa: F401
