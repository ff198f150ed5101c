"""Model plans: staging, intermediate, marts, analyses, metrics."""
