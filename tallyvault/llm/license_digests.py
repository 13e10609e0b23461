"""SHA-256 digests of the canonical forms (``license_scan.canonical``) of long licence texts.

The standard texts with and without their title lines and their closing instructions.  Fixed values.
"""

DIGESTS = [
    ("Apache-2.0", "036b5ff6d47b44974c624da95e5bf0ac7ddfe5030e41dfa7ff8ac0c1daa9f32b"),
    ("Apache-2.0", "6aa661403864282a4d084f1551e8149a5f1a7b5e8b05b6db8e1a8a28d0badc64"),
    ("Apache-2.0", "9dbe4591840ade1e884dd13b226aeca0b0bdedac3851e4921d30a1b2decee0eb"),
    ("Apache-2.0", "cbd2f5cd60a220d87a068defb58be1dceeb577659f65beecbee6cca031998de1"),
    ("Apache-2.0", "d7dd8e5c661e35d656a43688fc21624b0ba52216e4c419c747129bf83780d165"),
    ("Apache-2.0", "d849700f6ffe2241c4de5c4f77cc6ee7a152ddfbb1ec7385106677e743be07a7"),
    ("Apache-2.0", "f70a2718f78121f2da77cd6afbffffbd668d7c1fd36c85a3ef121e83cb5f48fe"),
    ("Apache-2.0", "fb388936c12fba660a278043424b3f9a17c6b2e536674e390813ac3d06e7e73a"),
    ("Apache-2.0", "fd919f036d84995f3a47212c6f8e319297b7a8bd19f7145bd18e1be12b9412ad"),
    ("Artistic-1.0-Perl", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
    ("Artistic-1.0-Perl", "4eaaa9e33aeef0af0ff83ab5edac0ad421a1da9cc861c564630460107b4b772c"),
    ("BSD-3-Clause", "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651"),
    ("CC0-1.0", "4f8ab63ace774f37529081c81e2730a88143bf70e67392bd3c3701bd0a175152"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("CC0-1.0", "a142ae38742c8c4c35f5fa19e0a40ebfa60fc38535daf9c570ca3d7e012e1e32"),
    ("GFDL-1.2", "2809defc601c10b3b793c1f61219c2ff7aebbd93c5f770019f0d93b2e7612377"),
    ("GFDL-1.2", "5379e6f33e826ba185b23fd11a414555c2161fda481478babd1e73a3ae098a71"),
    ("GFDL-1.2", "8ba1d3a5e77649f38fcf5eed49c963b94e6e5dd9030997c1b85bb7065eb316bc"),
    ("GFDL-1.2", "8d636e2e2f248f9b102e9d9f78337901ec8bca3bfe91434cdcf261a01bf305b1"),
    ("GFDL-1.2", "aa8e67692652aa0ece49069f2f9dffde6690debb563e627bab22508062ff269c"),
    ("GFDL-1.2", "c336ef6b93949c0756d0aa1e7db865fae35c1f15b41a8687feff7c27046c4b34"),
    ("GFDL-1.3", "2837649fc69f2b78b1c73c4bef637687dc74a9381faed9cf7df7eef537d330c0"),
    ("GFDL-1.3", "5b967c12b95f7d93d6f6004b6a40e177bcc0e67173d4cd222531f389cda0d765"),
    ("GFDL-1.3", "8b2e1bf047a0e628f2733f522e44835b432aec36a6a8b261627b2075435aefa2"),
    ("GFDL-1.3", "8b8b57bd195ed50d50edb5da1dd173b409fb9b075910c69726be7d0363c40008"),
    ("GFDL-1.3", "93d6108daecdddc5f284cf8f2512fb0d72f6e9ee12381feb9704ba194b00c3e6"),
    ("GFDL-1.3", "b26ac9ce9a4b4a24517e0f6069b823113eb7401ad3fe5934bdb1a8b533f70ba6"),
    ("GPL-1.0", "1ab50846e36ed0a28f141797e09d95ed25f9b464a051fe8e9c2b368ef16ab075"),
    ("GPL-1.0", "422dc6ece1afadb367f2bcdbf6ac496f4c7ad5c973c45cdd09ae377ceb4c8a12"),
    ("GPL-1.0", "526a998a5f0ae9ed2e8c2dc03c12942fc9d724df13b0787dd3c80881d3688444"),
    ("GPL-1.0", "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc"),
    ("GPL-1.0", "733356cadf8ca8b0ac2db2d593fb7c1a2b0528c7e891f8a911fdaeb64719fff5"),
    ("GPL-1.0", "7481518665d2db9ad29e3c605da9055f9b635541a3f6f50caea2de6e014e42f3"),
    ("GPL-1.0", "7843068060f4d9ee30736221ce49abf6cb7dafa9b775fabb47fbf0c21e05b102"),
    ("GPL-1.0", "89f75ffda938e788be38679f9f83e317c2a03398fccf03ee60505d44d1bf9f70"),
    ("GPL-1.0", "8f3791039a137dc41a4222725079093e91fe98d5b92a8a4c0619e88addd253c6"),
    ("GPL-1.0", "957cc3a7c373446b3a92dbd2972b96721e714f189d7998ddf1d7081209658305"),
    ("GPL-1.0", "9e12a40a9b22c45d116f19e1746b08ea0b853519de3e03ceb780f2a36d5f388c"),
    ("GPL-1.0", "c215578fef5b091713ee96d820330fd440a2d6bb8b3d607f8b5200fc3dcda67c"),
    ("GPL-2.0", "1d3015d0c95ac4c468939c7dc58e73a3f73a8592aa68d2af118ce60740773df7"),
    ("GPL-2.0", "4767c85efb312bbe244abef9b752be38b44e810f05ed9bfae182caf068d13fd3"),
    ("GPL-2.0", "6d332dc4c3c5293a73c6c9da402f9bbc970b3bb1eb472f577e00580573469808"),
    ("GPL-2.0", "8bce3c0010045bb9ea13c8025ec3c58d82fddf2d6f2f7a01d807e27da9edc024"),
    ("GPL-2.0", "8fa94d3d812775805528fff117ea835ed908322b039e129b957550c1e107d3e2"),
    ("GPL-2.0", "95aeb819f45bf6639f460cc0ba5fa250f81764324ef35320bf76fb9f99428fc1"),
    ("GPL-2.0", "a268f9c0a6d81f308a4286dac3b04b899da32e1ba02acf6eb78972ce623846e1"),
    ("GPL-2.0", "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-3.0", "15b5df1cc4fde465972f6b4e790713a04ab792461d0064a490fd856762946722"),
    ("GPL-3.0", "53a8724c31c96e487beed6b13b9656899f6f9f9a07af7aa783959306169f3492"),
    ("GPL-3.0", "a37974b0e78a8c32321bdac900b0bfa998900cf83b67d2a365af05d6c14573b5"),
    ("GPL-3.0", "a7f9e7be058f2470c456917b5e9db1a5998045f9a3a52dbf08bc557b48f84593"),
    ("GPL-3.0", "d97853dcfd574d3364bf2e1f6975f4177eeafac2bef29ba9718b133e7a77653c"),
    ("GPL-3.0", "f4893f051c20544249b11c854482c4d03cfb5a0ee34c1ffd76c3275bc5f261ea"),
    ("LGPL-2.0", "289c8b47fa0ec7e5f22cd33d32feaa06f015b0f2fdb9ad916979b1011ca8c015"),
    ("LGPL-2.0", "430627da7218a92ab4a6d75d5140cdb70ee750be7a53f913299b37e0d1b0eea2"),
    ("LGPL-2.0", "47c35e1c021b6c04445e474c1913cad6cf02f0a734eabf275fb91b033002a618"),
    ("LGPL-2.0", "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260"),
    ("LGPL-2.0", "6e6982d8bb4468c5ce7a88e400f1540201513f39e8dd96e3607ee631b813c06f"),
    ("LGPL-2.0", "73dbe68688642ea8753271a313d85ca880b4dc28379e1b21b2615f96758c5210"),
    ("LGPL-2.0", "81ecf332fc652bb79c23397a1431c72d1f39f01ffdcec61843942283b44f4688"),
    ("LGPL-2.0", "83b8d4dbf9305ed7f0e2038e8116d9e004e511f7086936ca17a574adb2ba29c2"),
    ("LGPL-2.0", "936eb024285b788f0eddbf96826d70da1adefa3099b0ec5336ffe495c00b7798"),
    ("LGPL-2.1", "127c98b05c4e2851a27843fcf90984e5592c3841d8a6b7638dbcd00bcefe46dd"),
    ("LGPL-2.1", "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4"),
    ("LGPL-2.1", "5ddd6039d3b090c51328879800301dd19b1ad99e14d00f3c6f221ab45a32db57"),
    ("LGPL-2.1", "7cc1b31b95dd0bec1ff475bffceda6889681862c0b7d0da58cf97d3ae0a5d4bf"),
    ("LGPL-2.1", "97ba2433c2fb6e3012b29d99da8a9266ffbe2ac42ab9565158c64d73a1f64e0a"),
    ("LGPL-2.1", "98d365a8217633113a201b5777e4d26ae0eb1d88079c5e39838162abe1f18db4"),
    ("LGPL-2.1", "bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df"),
    ("LGPL-2.1", "f0b3313d45a8a467f987a040dc16addaea95621fdaededc28db994fccd572d0e"),
    ("LGPL-2.1", "fb1aa46fd4fd870124c7b862a12be48912c95dfefb87fdd1bebda0f453e0a75e"),
    ("LGPL-3.0", "af4f466bab5554afad60c219ff8bf29eddb00df6ef0f1fcf73fa05ad4b3289f5"),
    ("LGPL-3.0", "fdfeb8bd001c33623f54980c670bf229b8c1b0d45f2ece1542f6eabf16498f29"),
    ("MPL-1.1", "3a6a0fe0030e6e755a04923126594a93aa582cc0213fe0e705392a915b23ee31"),
    ("MPL-1.1", "3f0343dd4f3b064be36e0c6584737c9b7bb5c322721694563f9009e088ce96d1"),
    ("MPL-1.1", "4fbf4b1f3d8cf5d05e627fcb1b0dded60f72dbb2e5c2bc5bb929a8db71982f2d"),
    ("MPL-1.1", "80cd52a1836f5ea3706bd2afa402fc448999d4a22581ee62d4041bd8a08efd87"),
    ("MPL-2.0", "075fcdf87448c49dbad8c5f7963f0eb6907a3d8eae1b431ba2988508499ec0de"),
    ("MPL-2.0", "2d37b31e2677d81ad128e61fc173ef1c2228dd0711022682ff745f3c65afac58"),
    ("MPL-2.0", "8f27174c93cb7f68399e5e71af858fdef9c2151b9de96b0dd9bab40a165711b3"),
    ("MPL-2.0", "d90ffcdf65277d9d3d5c8bf2314f6ab4eb2a578ff6cb0259918c436de24ff861"),
]
