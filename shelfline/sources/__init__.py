from shelfline.sources import landed, readers, report

__all__ = ["landed", "readers", "report"]
