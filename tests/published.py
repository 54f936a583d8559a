"""Published example values: strains with Gram stain, and two compounds' probabilities."""

# Fixed values: (strain, Gram stain, probability for Halicin, probability for Tannic acid).
PAIRS = [
    ("Akkermansia muciniphila (NT5021)", "negative", 0.021192694, 0.14810419),
    ("Bacteroides caccae (NT5050)", "negative", 0.20044225, 0.34634924),
    ("Bacteroides fragilis (ET) (NT5033)", "negative", 0.13638856, 0.41516623),
    ("Bacteroides fragilis (NT) (NT5003)", "negative", 0.31997114, 0.66925997),
    ("Bacteroides ovatus (NT5054)", "negative", 0.18697909, 0.6525264),
    ("Bacteroides thetaiotaomicron (NT5004)", "negative", 0.13655038, 0.6032843),
    ("Bacteroides uniformis (NT5002)", "negative", 0.20608483, 0.7926673),
    ("Bacteroides vulgatus (NT5001)", "negative", 0.20358992, 0.65930325),
    ("Bacteroides xylanisolvens (NT5064)", "negative", 0.14571722, 0.5150406),
    ("Bifidobacterium adolescentis (NT5022)", "positive", 0.13033158, 0.8262483),
    ("Bifidobacterium longum (NT5028)", "positive", 0.062367305, 0.87367266),
    ("Bilophila wadsworthia (NT5036)", "negative", 0.12167165, 0.37479854),
    ("Blautia obeum (NT5069)", "positive", 0.94394296, 0.96919596),
    ("Clostridium bolteae (NT5026)", "positive", 0.37628254, 0.6325356),
    ("Clostridium difficile (NT5083)", "positive", 0.4770033, 0.76485956),
    ("Clostridium perfringens (NT5032)", "positive", 0.18091147, 0.9400416),
    ("Clostridium ramosum (NT5006)", "positive", 0.15356177, 0.63179255),
    ("Clostridium saccharolyticum (NT5037)", "positive", 0.10375723, 0.9665654),
    ("Collinsella aerofaciens (NT5073)", "positive", 0.5390059, 0.931349),
    ("Coprococcus comes (NT5048)", "positive", 0.7449787, 0.81581396),
    ("Dorea formicigenerans (NT5076)", "positive", 0.37953573, 0.7600574),
    ("Eggerthella lenta (NT5024)", "positive", 0.4475104, 0.7122834),
    ("Escherichia coli ED1a (NT5078)", "negative", 0.042280074, 0.21520844),
    ("Escherichia coli IAI1 (NT5077)", "negative", 0.052755695, 0.3389818),
    ("Eubacterium eligens (NT5075)", "positive", 0.117745556, 0.6733014),
    ("Eubacterium rectale (NT5009)", "positive", 0.46077713, 0.7971731),
    ("Fusobacterium nucleatum (NT5025)", "negative", 0.22971949, 0.26971316),
    ("Lactobacillus paracasei (NT5042)", "positive", 0.0017916544, 0.39337808),
    ("Odoribacter splanchnicus (NT5081)", "negative", 0.18362293, 0.6697774),
    ("Parabacteroides distasonis (NT5074)", "negative", 0.07335632, 0.35253143),
    ("Parabacteroides merdae (NT5071)", "negative", 0.2151166, 0.5900811),
    ("Prevotella copri (NT5019)", "negative", 0.7571476, 0.41827977),
    ("Roseburia hominis (NT5079)", "positive", 0.15118462, 0.8130829),
    ("Roseburia intestinalis (NT5011)", "positive", 0.2040564, 0.89299095),
    ("Ruminococcus bromii (NT5045)", "positive", 0.28551665, 0.7250628),
    ("Ruminococcus gnavus (NT5046)", "positive", 0.19108754, 0.92325926),
    ("Ruminococcus torques (NT5047)", "positive", 0.15882453, 0.74494725),
    ("Streptococcus parasanguinis (NT5072)", "positive", 0.03342396, 0.84914875),
    ("Streptococcus salivarius (NT5038)", "positive", 0.016695198, 0.9259082),
    ("Veillonella parvula (NT5017)", "negative", 0.563656, 0.086976565),
]
# Score in all, Gram-negative, Gram-positive; strains inhibited in all, negative, positive; broad.
POTENTIAL = {
    "Halicin": (-1.8453829, -1.8742418, -1.8217711, 35, 16, 19, 1),
    "Tannic acid": (-0.5507032, -0.927215, -0.24264812, 40, 18, 22, 1),
}
# Example compounds.
MOLECULES = [
    ("Halicin", "C1=C(SC(=N1)SC2=NN=C(S2)N)[N+](=O)[O-]"),
    ("Abaucin", "C1CN(CCC12C3=CC=CC=C3NC(=O)O2)CCC4=CC=C(C=C4)C(F)(F)F"),
    ("Diacerein", "CC(=O)Oc1cccc2c1C(=O)c1c(OC(C)=O)cc(C(=O)O)cc1C2=O"),
    ("Elivitegravir", "COc1cc2c(cc1Cc1cccc(Cl)c1F)c(=O)c(C(=O)O)cn2C(CO)C(C)C"),
    ("Opicapone", "Cc1c(Cl)c(C)[n+]([O-])c(Cl)c1-c1noc(-c2cc(O)c(O)c([N+](=O)[O-])c2)n1"),
    ("Ebastine", "CC(C)(C)c1ccc(C(=O)CCCN2CCC(OC(c3ccccc3)c3ccccc3)CC2)cc1"),
]
