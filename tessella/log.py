"""Driver-side logging to the console and a rotating file."""

from __future__ import annotations

import logging
from logging.handlers import RotatingFileHandler
from pathlib import Path

FORMAT = "%(asctime)s %(levelname)s %(name)s: %(message)s"


def setup_logger(name: str, level: int = logging.INFO, log_file: str | Path | None = None, console: bool = True, file_level: int = logging.DEBUG) -> logging.Logger:
    """A logger with fresh handlers; the file grows to 10 MB and keeps five predecessors."""
    logger = logging.getLogger(name)
    logger.handlers.clear()
    logger.setLevel(min(level, file_level) if log_file else level)
    handlers: list[tuple[logging.Handler, int]] = [(logging.StreamHandler(), level)] if console else []
    if log_file:
        Path(log_file).parent.mkdir(parents=True, exist_ok=True)
        handlers.append((RotatingFileHandler(log_file, maxBytes=10 << 20, backupCount=5, encoding="utf-8"), file_level))
    for handler, own in handlers:
        handler.setLevel(own)
        handler.setFormatter(logging.Formatter(FORMAT))
        logger.addHandler(handler)
    return logger


def enable_debug_mode(logger: logging.Logger) -> None:
    """Everything from here on is shown, by the logger and all that it writes to."""
    for part in (logger, *logger.handlers):
        part.setLevel(logging.NOTSET + 1)
