"""DataFrame operators: staging, dimensions, marts, serving, features, insights, forecasting, segmentation, sampling."""
