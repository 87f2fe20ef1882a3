"""Data products: shop analytics, compute-usage cost, cloud-bill cost."""
