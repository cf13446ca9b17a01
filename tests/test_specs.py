import pytest

from lakezones.specs import ContractError, TableSpec, load_specs, select_table

CONTRACTS = {
    "full_load": {
        "customers": {"primary_key": "id", "required_columns": ["first_name", "last_name", "email"],
                      "make_created_at": True, "make_updated_at": True},
        "orders": {"primary_key": "id", "required_columns": ["order_date", "purchaser", "quantity", "product_id"],
                   "make_created_at": True, "make_updated_at": False},
    }
}


def test_load_all_and_one():
    specs = load_specs(CONTRACTS)
    assert set(specs) == {"customers", "orders"}
    assert specs["orders"].primary_key == ("id",)
    assert specs["orders"].make_updated_at is False
    assert list(load_specs(CONTRACTS, table="customers")) == ["customers"]


def test_unknown_table_and_mode():
    with pytest.raises(ContractError, match="does not exist"):
        load_specs(CONTRACTS, table="nope")
    with pytest.raises(ContractError):
        load_specs(CONTRACTS, mode="delta_load")
    with pytest.raises(ContractError):
        select_table(load_specs(CONTRACTS), "nope")


def test_empty_required_columns_rejected():
    with pytest.raises(ContractError, match="mandatory"):
        TableSpec("t", required_columns=())


def test_missing_columns_reported():
    spec = load_specs(CONTRACTS)["customers"]
    assert spec.missing_columns(["id", "first_name"]) == ["last_name", "email"]
    with pytest.raises(ContractError, match="missing"):
        spec.check(["id", "first_name"])
    spec.check(["id", "first_name", "last_name", "email", "extra"])


def test_yaml_file(tmp_path):
    import yaml

    p = tmp_path / "db.yaml"
    p.write_text(yaml.safe_dump(CONTRACTS))
    assert load_specs(str(p))["customers"].required_columns == ("first_name", "last_name", "email")


def test_config_is_json_ready():
    cfg = load_specs(CONTRACTS)["customers"].config()
    assert cfg["required_columns"] == ["first_name", "last_name", "email"]
    assert cfg["primary_key"] == ["id"]
