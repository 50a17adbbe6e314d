"""Models by name; importing the package registers those of the second source."""

from tallyframe.models import erp_masters as erp_masters
