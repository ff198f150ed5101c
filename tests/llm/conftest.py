import pytest

from funnelworks.llm.prepare import prepared


@pytest.fixture
def ready(spark):
    return prepared(spark)
