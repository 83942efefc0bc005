"""Named queries over the test tables."""


def load_all() -> None:
    """Import every query module, which fills the registry."""
    from wayspan.plans import charts, cleaning, quality, scoring  # noqa: F401
