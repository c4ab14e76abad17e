"""Training-data operators: ten independent modules, their queries in ``queries``."""
