"""DataFrame operators of the traffic reports."""
