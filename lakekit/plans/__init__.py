"""Named queries over the given tables, one module per operator family."""

from importlib import import_module
from pkgutil import iter_modules


def load_all() -> None:
    for module in iter_modules(__path__):
        import_module(f"{__name__}.{module.name}")
