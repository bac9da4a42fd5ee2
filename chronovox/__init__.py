"""Analytics over collections of 4-D image time series, as DataFrame and SQL plans."""
