from ..plans.flagship import FLAGSHIP_SQL, flagship
from . import register

register("flagship", FLAGSHIP_SQL)(flagship)
