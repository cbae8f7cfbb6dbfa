from loadwright.streaming.watch import watch_deliveries

__all__ = ["watch_deliveries"]
