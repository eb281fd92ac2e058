from folioflow.functions import dates, naming, payload, text, urls

__all__ = ["dates", "naming", "payload", "text", "urls"]
