"""Options the jobs share."""

from __future__ import annotations

from argparse import ArgumentParser, ArgumentTypeError
from datetime import timedelta


def pair(text: str) -> tuple[str, str]:
    key, sign, value = text.partition("=")
    if not (key and sign):
        raise ArgumentTypeError(f"expected key=value, got {text!r}")
    return key, value


def hours(text: str) -> timedelta:
    return timedelta(hours=float(text))


def add_options(parser: ArgumentParser, name: str, what: str) -> None:
    """A repeatable ``key=value`` option, collected into a list of pairs."""
    parser.add_argument(
        f"--{name}", type=pair, action="append", default=[], metavar="KEY=VALUE", help=what
    )
