import pytest


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def prepared(spark):
    from laketide.llm.common import prepare
    prepare(spark)
